import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest

from candlewick.llm import phrases, queries

WORD = r"[^\x20\x09]+"


def counts(rows):
    out = Counter()
    for lang, text in rows:
        text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(WORD, piece)
            for size in range(1, 5):
                for i in range(len(words) - size + 1):
                    out[lang or "und", " ".join(words[i:i + size])] += 1
    return out


def brute(rows, least, most=2000):
    every = counts(rows)
    totals = Counter()
    for (lang, phrase), n in every.items():
        totals[lang] += n * (" " not in phrase)
    frequent = {k: n for k, n in every.items() if n >= least}
    covered = set()
    for (lang, phrase), n in frequent.items():
        words = phrase.split(" ")
        for size in range(2, len(words)):
            for i in range(len(words) - size + 1):
                inner = " ".join(words[i:i + size])
                if 100 * n >= 80 * frequent[lang, inner]:
                    covered.add((lang, inner))
    found = defaultdict(list)
    for (lang, phrase), a in frequent.items():
        words = phrase.split(" ")
        if len(words) < 2 or (lang, phrase) in covered:
            continue
        cuts = [(frequent[lang, " ".join(words[:k])], frequent[lang, " ".join(words[k:])]) for k in range(1, len(words))]
        score, _, l, r = min((2000000 * a // (l + r), k, l, r) for k, (l, r) in enumerate(cuts))
        found[lang].append((-score, -a, phrase.encode(), l, r))
    return {(lang, i, p.decode(), -a, l, r, totals[lang], -s)
            for lang, own in found.items() for i, (s, a, p, l, r) in enumerate(sorted(own)[:most], 1)}


def got(df, **options):
    rows = [tuple(r) for r in phrases.collocations(df, **options).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def corpus(seed, n=160):
    rng = random.Random(seed)
    words = ["alpha", "Beta", "gamma", "delta", "é", "日本", "x1", "of", "the", "the"]
    def text():
        out = []
        for _ in range(rng.randrange(0, 40)):
            out.append(rng.choice(["new york city hall", "of the", *words]))
            out.append(rng.choice([" ", " ", " ", " ", "\t", " , ", ". ", "\n", "! ", "  "]))
        return "".join(out)
    return [(rng.choice(["en", "de", None]), text()) for _ in range(n)] + [("en", None), (None, ""), ("fr", " . ")]


# One slot bit: every phrase shares a slot with half of all others. Chunks of 50 bytes: texts are cut anywhere.
@pytest.mark.parametrize("shards, slot_bits, chunk", [(3, 1, 50), (2, 20, 300)])
def test_against_brute_force(spark, shards, slot_bits, chunk):
    rows = corpus(shards)
    df = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    found = got(df, least=5, shards=shards, slot_bits=slot_bits, chunk=chunk)
    assert found == brute(rows, 5) and len(found) > 30
    assert {r for r in found if r[1] <= 7} == brute(rows, 5, 7)


def test_all_counts_are_exact(spark):
    rows = corpus(9)
    frequent, words = phrases.count_phrases(spark.createDataFrame(rows, "lang string, text string").repartition(2), least=4, shards=1, slot_bits=10)
    want = {k: n for k, n in counts(rows).items() if n >= 4}
    assert {(r["lang"], r["phrase"]): r["n"] for r in frequent.collect()} == want
    assert {r["lang"] for r in words.collect()} == {"en", "de", "und"}


def test_late_phrases_are_activated_in_later_cycles(spark):
    """A pair whose words are rare in all shards but the last one begins a cycle late, and its triple another."""
    rows = [("en", f"filler{i}") for i in range(30)] + [("en", "late riser here now")] * 7
    found = got(spark.createDataFrame(rows, "lang string, text string").coalesce(1), least=7, shards=3, slot_bits=16)
    assert found == brute(rows, 7) == {("en", 1, "late riser here now", 7, 7, 7, 58, 1000000)}


@pytest.mark.parametrize("slot_bits", [1, 3])
def test_late_phrases_that_share_slots_with_early_ones(spark, slot_bits):
    rng = random.Random(slot_bits)
    rows = [("en", " ".join(rng.choice("abcd") for _ in range(9))) for _ in range(40)]
    rows += [("en", f"late{i % 2} riser{i % 2} here now" + rng.choice([" a b", ""])) if rng.random() < i / 60 else ("en", "c d a") for i in range(60)]
    found = got(spark.createDataFrame(rows, "lang string, text string").coalesce(1), least=12, shards=4, slot_bits=slot_bits)
    assert found == brute(rows, 12) and any("late1 riser1 here now" in r for r in found)


@pytest.fixture
def tables(monkeypatch):
    """The rows of all tables that are staged, by name."""
    stage, found = phrases.stage, {}
    def kept(df, name, *parted_by):
        out, path = stage(df, name, *parted_by)
        found[name] = out.collect()
        return out, path
    monkeypatch.setattr(phrases, "stage", kept)
    monkeypatch.setattr(phrases, "staged", lambda *a: kept(*a)[0])
    return found


@pytest.mark.parametrize("n", [9, 10])
def test_phrases_of_the_limit_that_are_dealt_evenly(spark, tables, n):
    """A phrase of ten is found three times in two shards and twice in two: only the first are kept, and tell that it may be frequent."""
    rows = [("en", "red kite soars high")] * n + [("en", f"{i:05} {i:05} {i:07}") for i in range(30)]
    found = got(spark.createDataFrame(rows, "lang string, text string").coalesce(1), least=10, shards=4, slot_bits=16, chunk=20)
    assert found == brute(rows, 10) and len(found) == (n == 10)
    assert [len([r for r in tables["shards"] if r["shard"] == k and b"kite" in r["known"]]) for k in range(4)] == [3, 2 + (n > 9), 2, 2]
    assert ("scan15" in tables) == (n == 10)


def test_rare_phrases_are_not_carried_from_scan_to_scan(spark, tables):
    rows = corpus(4)
    df = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    found = got(df, least=6, shards=3, slot_bits=20, chunk=60)
    assert found == brute(rows, 6) and len(found) > 30
    assert all(r["n"] >= 2 for name in tables if name.startswith("running") for r in tables[name])
    assert any(r["n"] == 1 for name in tables if name.startswith("scan") for r in tables[name])
    # Nor are those counted further there that have reached the limit.
    done = set()
    for scan in range(sum(name.startswith("running") for name in tables)):
        running = [r for r in tables[f"running{scan}"] if r["length"] < 4]
        assert not done & {r["hash"] for r in running}
        done |= {r["hash"] for r in running if r["n"] >= 6}
    assert len(done) > 30


def test_texts_are_split_into_words_once(spark, tables):
    """The shards hold coded words, no text that every scan would split again."""
    rows = corpus(5)
    got(spark.createDataFrame(rows, "lang string, text string").repartition(2), least=5, shards=2, slot_bits=16, chunk=200)
    coded = Counter()
    for r in tables["shards"]:
        known, codes = r["known"].split(), memoryview(pa.decompress(r["codes"], 4 * r["size"], "zstd", asbytes=True)).cast("I")
        coded.update((r["lang"], known[k].decode()) for k in codes[r["carried"]:] if k)
    assert coded == {k: n for k, n in counts(rows).items() if " " not in k[1]}


def test_runs_hold_every_word_once():
    rng = random.Random(3)
    for most in (1, 7, 20, 64):
        for _ in range(60):
            text = phrases.pieces_of("".join(rng.choice("abc   ,.\t") for _ in range(rng.randrange(200))).encode())
            got_ = Counter()
            for run, carried in phrases.runs(text, most):
                tokens = run.replace(b"\xff", b" \xff ").split()
                for size in range(1, 5):
                    for i in range(len(tokens) - size + 1):
                        if b"\xff" not in tokens[i:i + size] and i + size > carried:
                            got_["und", b" ".join(tokens[i:i + size]).decode()] += 1
            assert got_ == counts([(None, text.replace(b"\xff", b".").decode())])


def test_exact_beyond_64_bits(spark):
    big = 9 * 10 ** 15
    rows = [("en", 1, "a", big), ("en", 1, "b", big + 7), ("en", 2, "a b", big - 1)]
    (row,) = phrases.scored(spark.createDataFrame(rows, "lang string, length byte, phrase string, n long")).collect()
    assert row["score"] == 2000000 * (big - 1) // (2 * big + 7) and (row["l"], row["r"]) == (big, big + 7)


def test_awkward_documents(awkward, nothing):
    rows = [(r["lang"], r["text"]) for r in awkward.collect()]
    assert got(awkward, least=2, shards=2, slot_bits=16) == brute(rows, 2)
    assert got(nothing, shards=1, slot_bits=16) == set()


def test_query_on_given_documents(spark, documents):
    rows = {tuple(r) for r in queries.QUERIES["op12_phrase_collocations"](spark, "/root/testdata/sf0.001").collect()}
    assert rows == brute([(r["lang"], r["text"]) for r in documents.collect()], 30)
