import hashlib
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from candlewick.llm import common, linededup, queries

BLANK = "\x20\x09\x0a\x0b\x0c\x0d"


def key(line):
    return re.sub("[A-Z]", lambda m: m.group().lower(), line.strip(BLANK))


def brute(rows, least_chars=20, least_docs=3):
    """[(doc_id, lines, dropped, text)] of every row; a null id is a document below every other."""
    rank = lambda i: (i is not None, i or 0)
    holders = defaultdict(set)
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= least_chars:
                holders[key(line)].add(rank(doc_id))
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(holders.get(key(x), ())) < least_docs or max(holders[key(x)]) == rank(doc_id)]
        out.append((doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def got(df, **options):
    cut = linededup.dedup_lines(df, **options)
    return sorted((tuple(r) for r in cut.select("doc_id", "_cw_lines", "_cw_dropped", "text").collect()), key=repr)


@pytest.mark.parametrize("broadcast", [200_000, 5, 1])
def test_against_brute_force(spark, monkeypatch, broadcast):
    """Small limits of the broadcast send the common lines one way and the others another."""
    monkeypatch.setattr(common, "BROADCAST_ROWS", broadcast)
    rng = random.Random(broadcast)
    pool = ["Shared LINE number %d of the pool" % i for i in range(12)] + ["short one", "", "  ", "ÄÖÜ SHARED Ünïcode line of some length",
                                                                     "exactly twenty chars", "exactly nineteen ch"]
    def line():
        text = rng.choice(pool) if rng.random() < 0.5 else "own line %d of this document" % rng.randrange(10 ** 9)
        return rng.choice(["", " ", "\t", "\r", "\x0b "]) + rng.choice([text, text.upper(), text]) + rng.choice(["", "\r", " \x0c"])
    rows = [(rng.choice([None, *range(40)]), "\n".join(line() for _ in range(rng.randrange(0, 9)))) for _ in range(120)]
    rows += [(7, "a common line that everyone has\nb"), (None, "a common line that everyone has"), (None, None)] * 4
    rows += [(100 + i, "a common line that everyone has\nand another line that everyone has\n" * i) for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert got(df) == brute(rows)
    assert got(df, least_chars=3, least_docs=2) == brute(rows, 3, 2)


def test_edges(spark):
    line = "this line is long enough"
    rows = [(1, None), (2, ""), (3, f"{line}\n{line}"), (4, f"\n{line.upper()} \n"), (5, line), (5, line), (6, "\n\n"), (9, line[:19]), (10, line[:19]), (11, line[:19])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(df) == brute(rows)
    by_id = {r[0]: r for r in got(df)}
    assert by_id[1][1:] == by_id[2][1:] == (1, 0, "")
    assert by_id[3][1:] == (2, 2, "") and by_id[4][1:] == (3, 1, "\n") and by_id[5][1:] == (1, 0, line) and by_id[6][1:] == (3, 0, "\n\n")
    # One id is one document, however many rows it has.
    assert [r[2] for r in got(spark.createDataFrame([(1, line)] * 5 + [(2, line)], df.schema))] == [0] * 6


def test_very_long_document(spark):
    text = "\n".join(f"line number {i % 50_000} of a very long document" for i in range(120_000))
    rows = [(1, text), (2, text), (3, text[: len(text) // 2])]
    assert got(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def test_awkward_documents(awkward, nothing):
    cut = linededup.dedup_lines(awkward)
    assert cut.columns == [*awkward.columns, "_cw_lines", "_cw_dropped"] and cut.count() == awkward.count()
    assert {r["key"] for r in cut.collect()} == {"own key"}
    assert got(awkward) == brute([(r["doc_id"], r["text"]) for r in awkward.collect()])
    assert linededup.dedup_lines(nothing).count() == 0


def test_query_on_given_documents(spark, documents):
    rows = queries.QUERIES["op11_line_dedup"](spark, "/root/testdata/sf0.001").collect()
    want = brute([(r["doc_id"], r["text"]) for r in documents.collect()])
    assert sorted((tuple(r) for r in rows), key=repr) == sorted(
        ((i, n, gone, hashlib.sha256(text.encode()).hexdigest()) for i, n, gone, text in want), key=repr)
    assert sum(r["n_dropped"] for r in rows) > 0


def test_no_python_and_no_text_in_the_count(spark, documents):
    frame = linededup.frequent_lines(documents)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert all("text" not in line for line in plan.splitlines() if "Exchange" in line)
    assert frame.where(F.col("documents") < 3).count() == 0
