from collections import defaultdict

import pytest

from candlewick.llm import decontaminate as D

ITEMS = [
    (1, "Anna bought 12 apples for 3 dollars each and gave Peter 5 of them back. How many dollars did she pay?"),
    (2, "The river flows slowly past the old mill while seven grey herons wait for fish in the shallow water."),
    (3, "too short"), (4, None), (5, "1 2 3 4 5 6 7 8 9 10"),
    (6, "The river flows slowly past the old mill while seven grey herons wait for fish in the shallow water."),
]


def template(text):
    kinds, values = [], []
    for line in (text or b"").decode("utf-8", "replace").split("\n"):
        begins, named = True, False
        for word in line.split():
            found, stops = D.word_tokens(word)
            for kind, value in found:
                if kind is D.NAME and begins:
                    kind = value
                if kind is D.NAME and named:
                    values[-1] += " " + value
                else:
                    kinds.append(kind)
                    values.append(value)
                named, begins = kind is D.NAME, False
            if stops:
                begins, named = True, False
    return kinds, values


def brute_windows(text):
    kinds, values = template(text)
    out = []
    for i in range(len(kinds) - D.WINDOW + 1):
        part = kinds[i:i + D.WINDOW]
        if sum(k not in D._SLOTS for k in part) >= D.LITERALS:
            out.append((i, tuple(part), tuple(k + v for k, v in zip(part, values[i:]) if k in D._SLOTS)))
    return out


def brute(docs, items):
    """{(place of the text, item)}: the definition, by all pairs."""
    found = set()
    for d, text in enumerate(docs):
        mine = brute_windows(text)
        for item, question in items:
            theirs = brute_windows(question)
            by_distance = defaultdict(list)
            for pos, kinds, slots in mine:
                for at, other, values in theirs:
                    if kinds == other:
                        by_distance[pos - at].append((at, values, slots))
            covered = set()
            for rows in by_distance.values():
                stands = defaultdict(set)
                for _, values, slots in rows:
                    for a, b in zip(values, slots):
                        stands[a].add(b)
                if all(len(s) == 1 for s in stands.values()):
                    covered |= {at + k for at, *_ in rows for k in range(D.WINDOW)}
            size = len({at + k for at, *_ in theirs for k in range(D.WINDOW)})
            if size and len(covered) >= size * D.COVERAGE:
                found.add((d, item))
    return found


DOCS = {
    "exact": "Some words before. " + ITEMS[0][1] + " And after.",
    "other numbers and names": "Berta bought 20 apples for 7 dollars each and gave Hans 8 of them back. How many dollars did she pay?",
    "shouted": ITEMS[1][1].upper(),
    "in a table": " | ".join(ITEMS[1][1].split()),
    "an edit": ITEMS[1][1].replace("grey", "white"),
    "half": ITEMS[1][1][:50] + " and that is all there was to say about it.",
    "names torn": "Anna bought 12 apples for 3 dollars each and gave Peter 5 of them back. " * 1,
    "clean": "Nothing of the kind, only 5 apples for 3 dollars and an old mill by the river.",
    "only numbers": "1 2 3 4 5 6 7 8 9 10 11 12",
}


def test_named_cases(spark):
    df = spark.createDataFrame(list(enumerate(DOCS.values())), "doc_id long, text string")
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    names = list(DOCS)
    got = {names[r["doc_id"]]: r["items"] for r in D.contaminated(df, bench).collect()}
    assert got["exact"] == got["other numbers and names"] == [1]
    assert got["shouted"] == got["in a table"] == got["an edit"] == [2]
    assert got["half"] == got["clean"] == got["only numbers"] == []


def test_slots_must_be_consistent(spark):
    item = "Take 4 eggs and then 4 cups of milk and beat all 4 eggs with the milk until 9 bubbles rise to the top."
    good = item.replace("4", "6").replace("9", "2")
    torn = "Take 4 eggs and then 5 cups of milk and beat all 6 eggs with the milk until 9 bubbles rise to the top."
    df = spark.createDataFrame([(1, good), (2, torn)], "doc_id long, text string")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    assert {r["doc_id"]: r["contaminated"] for r in D.contaminated(df, bench).collect()} == {1: True, 2: False}


def test_windows_against_the_plain_loop(documents):
    texts = [r["text"].encode() for r in documents.collect()] + [b"", None, b"a b", "He paid $5.50 to John Smith for 3 kg of Fine Tea. 10km . Mary".encode()]
    lexicon = D.Lexicon()
    got = [(i, pos, tuple(kinds.split(" ")), tuple(slots)) for i, _, pos, kinds, slots, _ in D.template_windows(texts, lexicon)]
    assert got == [(i, *w) for i, t in enumerate(texts) for w in brute_windows(t)]


def test_documents_against_brute_force(spark, documents):
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    rows, items = documents.collect(), [(r["item_id"], r["text"].encode()) for r in bench.collect()]
    want = {(rows[d]["doc_id"], i) for d, i in brute([r["text"].encode() for r in rows], items)}
    got = {(r["doc_id"], i) for r in D.contaminated(documents, bench).collect() for i in r["items"]}
    assert got == want and got
    left = D.drop_contaminated(documents, bench)
    assert {r["doc_id"] for r in left.collect()} == {r["doc_id"] for r in rows} - {d for d, _ in want} and left.columns == documents.columns


@pytest.mark.parametrize("some", ["docs", "items", "both"])
def test_awkward_documents(spark, awkward, nothing, some):
    bench = spark.createDataFrame(ITEMS + [(9, "same text as the next one has it")], "item_id long, text string")
    docs = awkward if some in ("docs", "both") else nothing
    bench = bench if some in ("items", "both") else bench.limit(0)
    rows = D.contaminated(docs, bench).collect()
    assert len(rows) == docs.count()
    hit = sorted(r["doc_id"] for r in rows if r["contaminated"])
    assert hit == ([4, 4, 5] if some == "both" else [])
    left = D.drop_contaminated(docs, bench)
    assert left.columns == docs.columns and left.count() == len(rows) - len(hit)


def test_items_without_id_and_with_one_id_are_told_apart(spark):
    """A null id joins nothing, and two texts of one id must not share a size or an alignment."""
    short = "Every winter the two old sailors repaired their wooden boat beside the frozen harbour wall alone"
    long = " ".join(f"part{c} of the {c}{c} story goes on" for c in "abcdefghijk")
    docs = [(1, "So. " + ITEMS[1][1]), (2, "Then. " + short), (3, "And. " + long), (4, "nothing of the kind is in here at all")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame([(None, ITEMS[1][1]), (0, short), (0, long)], "item_id long, text string")
    got = {r["doc_id"]: (r["contaminated"], r["items"], r["covered"]) for r in D.contaminated(df, bench).collect()}
    assert got == {1: (True, [], 1.0), 2: (True, [0], 1.0), 3: (True, [0], 1.0), 4: (False, [], 0.0)}
    assert [r["doc_id"] for r in D.drop_contaminated(df, bench).collect()] == [4]


def test_a_phrase_of_many_items_makes_no_pairs(spark, monkeypatch):
    """400 documents and 400 items share a phrase: only the one document that holds an item is matched with one."""
    def letters(i, n):
        return " ".join("".join(chr(97 + int(d)) for d in f"{i}{j}") for j in range(n))
    items = [(i, f"what is the value of the {letters(1000 + i, 14)}") for i in range(400)]
    docs = [(i, f"so what is the value of the {letters(5000 + i, 14)}") for i in range(400)] + [(999, "well , " + items[7][1])]
    sizes, keep = {}, D.staged

    def counted(df, name, *rest):
        out = keep(df, name, *rest)
        sizes[name] = out.count()
        return out
    monkeypatch.setattr(D, "staged", counted)
    rows = D.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert [(r["doc_id"], r["items"]) for r in rows if r["contaminated"]] == [(999, [7])]
    assert sizes["matches"] <= 20 and sizes["near"] >= 400


def test_probes_leave_too_little_covered(spark):
    import random
    rng = random.Random(3)
    items = [(i, " ".join(rng.choice("abcdefg") * 3 for _ in range(rng.randrange(5, 40)))) for i in range(60)]
    found = D.item_windows(spark.createDataFrame(items, "item_id long, text string"))
    probes = {(bytes(r["item_key"]), r["hash"], r["template"]) for r in D.probes_of(found).collect()}
    places, left = {}, {}
    for r in found.collect():
        spot = set(range(r["pos"], r["pos"] + D.WINDOW))
        places.setdefault(bytes(r["item_key"]), set()).update(spot)
        if (bytes(r["item_key"]), r["hash"], r["template"]) not in probes:
            left.setdefault(bytes(r["item_key"]), set()).update(spot)
    assert places and all(len(left.get(k, ())) < len(p) * D.COVERAGE for k, p in places.items())
