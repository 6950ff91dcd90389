import random

import pytest
from pyspark.sql import functions as F

from candlewick.llm import quality


def brute(text):
    text = text or ""
    import re
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines, seen, dup = text.split("\n"), set(), 0
    for line in lines:
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    marked = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(i, i + 5)}
    n = len(words)
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(marked), n < 10 or 100 * len(marked) > 20 * n)


def test_base_rules_against_brute_force(spark):
    rng = random.Random(1)
    texts = [" ".join(rng.choice(["a", "b", "é#", "x\n", "\t", "日本", "\u00a0"]) for _ in range(rng.randrange(60))) for _ in range(200)]
    df = spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)], "doc_id long, text string, source string")
    for r in quality.quality(df).collect():
        assert tuple(r)[1:7] == brute(texts[r["doc_id"]])


def test_awkward_documents(awkward, nothing):
    rows = quality.quality(awkward).collect()
    texts = {r["doc_id"]: r["text"] for r in awkward.collect() if len(r["text"] or "") < 100_000}
    assert len(rows) == awkward.count()
    for r in rows:
        if r["doc_id"] in texts:
            assert tuple(r)[1:7] == brute(texts[r["doc_id"]])
    assert quality.quality(nothing).count() == 0
    assert quality.clean(nothing).count() == 0
    assert quality.clean(awkward).columns == awkward.columns


@pytest.fixture(scope="module")
def boiled(spark):
    """Sixty documents of one host share two lines; one document is nothing else; a second host has the lines once."""
    line, other = "Accept all  COOKIES on page 7 to go on reading here", "all of this is footer text of the page"
    def body(i):
        return " ".join("".join(chr(97 + int(d)) for d in f"{i}{j}") for j in range(20))
    rows = [(i, f"{line.replace('7', str(i % 10))}\n{body(i)}\n{other}", "a", 1) for i in range(100, 160)]
    rows += [(200, f"{line}\n{other}\na few words", "a", 1), (201, f"{line}\n{body(201)}", "b", 1)]
    rows += [(300 + i, body(999) + "\n" + body(998), "a", 1) for i in range(200)]  # exact copies count once
    return spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long").repartition(5)


def test_lines_that_many_documents_share(boiled):
    rows = {r["doc_id"]: r for r in quality.quality(boiled).collect()}
    assert rows[100]["lines_lost"] == 0 and rows[100]["kept"]  # the first keeps them
    assert all(rows[i]["lines_lost"] == 2 and rows[i]["kept"] for i in range(101, 160))
    assert rows[200]["words_left"] == 3 and not rows[200]["kept"] and not rows[200]["base_failed"]
    assert rows[201]["lines_lost"] == 0 and rows[201]["kept"]
    assert all(rows[300 + i]["kept"] and rows[300 + i]["lines_lost"] == 0 for i in range(200))


def test_cleaned_texts(boiled):
    got = {r["doc_id"]: r for r in quality.clean(boiled.withColumn("_x", F.lit(1))).collect()}
    assert set(got) == {r["doc_id"] for r in boiled.collect()} - {200}
    assert got[120]["text"].startswith("bcaa bcab") and "\n" not in got[120]["text"] and got[120]["n_chars"] == len(got[120]["text"])
    assert got[201]["n_chars"] == 1


def test_other_documents_of_the_host_do_not_bring_a_line_back(spark):
    """A footer of several words goes however large its host is; a short line only where a share of the host has it."""
    footer, short = "all rights reserved by the owner of this page", "read more here"

    def words(i):
        return " ".join("w" + "".join(chr(97 + int(d)) for d in f"{i}x{j}".replace("x", "0")) for j in range(12))
    rows = [(i, f"{footer}\n{footer} {i}\n{short}", "a") for i in range(60)] + [(1000 + i, words(i), "a") for i in range(2000)]
    got = {r["doc_id"]: r for r in quality.quality(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    few = {r["doc_id"]: r for r in quality.quality(spark.createDataFrame(rows[:60], "doc_id long, text string, source string")).collect()}
    assert [i for i in range(60) if got[i]["kept"]] == [i for i in range(60) if few[i]["kept"]]
    assert sum(got[i]["kept"] for i in range(60)) < 60 and all(got[i]["lines_lost"] == few[i]["lines_lost"] - 1 for i in range(1, 60))
    assert all(got[1000 + i]["kept"] for i in range(2000))
