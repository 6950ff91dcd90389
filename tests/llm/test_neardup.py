import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from candlewick.llm import components, neardup as N


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps):
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    known = list(root)
    for i, a in enumerate(known):
        for b in known[:i]:
            if (a ^ b).bit_count() <= 3:
                root[find(a)] = find(b)
    return {f: find(f) for f in known}


def check(docs):
    rows = docs.select("doc_id", "text").collect()
    short = [(r[0], r[1]) for r in rows]
    fps = [brute_fingerprint(t) for _, t in short]
    roots = brute_components(fps)
    least = {}
    for (i, _), f in zip(short, fps):
        if i is not None:
            least[roots[f]] = min(i, least.get(roots[f], i))
    want = sorted(((i is None, i or 0, f"{f:016x}", least.get(roots[f])) for (i, _), f in zip(short, fps)), key=repr)
    got = sorted(((r["doc_id"] is None, r["doc_id"] or 0, r["fingerprint"], r["component_id"]) for r in N.near_duplicates(docs).collect()), key=repr)
    assert got == want
    return len({roots[f] for f in fps})


def test_documents_against_brute_force(documents):
    groups = check(documents)
    kept = N.keep_one(documents)
    assert kept.count() == groups and kept.columns == documents.columns


def test_spark_hashes_alike(spark):
    text = "ab Ünï 日本"
    assert spark.sql(f"SELECT xxhash64('{text}')").first()[0] % (1 << 64) == xxhash.xxh64_intdigest(text.encode(), 42)


def test_awkward_documents(awkward, nothing):
    groups = check(awkward)
    kept = N.keep_one(awkward)
    assert kept.count() == groups and kept.columns == awkward.columns
    assert {4} == {r["doc_id"] for r in kept.where("text like 'same%'").collect()}
    assert N.near_duplicates(nothing).count() == 0 and N.keep_one(nothing).count() == 0


def clusters(rng, n):
    out = set()
    while len(out) < n:
        base = rng.getrandbits(64)
        for _ in range(rng.choice([1, 1, 1, 40])):
            out.add(base ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(5))))
    return sorted(out)


@pytest.mark.parametrize("four, three, crowd, block", [(1 << 19, 1 << 26, 64, 2048), (1 << 19, 1 << 26, 3, 8), (0, 1 << 26, 64, 2048), (0, 1 << 26, 2, 4),
                                                        (0, 0, 64, 2048)])
def test_no_link_is_lost(spark, monkeypatch, four, three, crowd, block):
    """Two, three and four parts, with and without crowds: the same components as by comparing all pairs."""
    for name, value in (("FOUR_PARTS", four), ("THREE_PARTS", three), ("CROWD", crowd), ("BLOCK", block)):
        monkeypatch.setattr(N, name, value)
    rng = random.Random(four + three + crowd)
    fps = clusters(rng, 500)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(i, f) for i, f in enumerate(signed)], "id long, _cw_fp long").repartition(4)
    got = {r["_cw_fp"] % (1 << 64): r["root"] for r in N.components(df, "id").collect()}
    want = brute_components(fps)
    groups = lambda m: sorted(sorted(f for f in m if m[f] == r) for r in set(m.values()))
    assert groups(got) == groups(want)


def test_thresholds_keep_the_pigeonhole():
    rng = np.random.default_rng(1)
    parts = [list(range(i, 64, 4)) for i in range(4)]
    histograms = [rng.poisson(1.5, 1 << 16).astype(np.int32) for _ in parts]
    costs = [[c.astype(np.float32) for c in N.near_counts(h, 16, 3)] for h in histograms]
    values = [rng.integers(0, 1 << 16, 300) for _ in parts]
    got = N.allocate(N.Plan(parts, histograms, costs, 3), values)
    assert ((got + 1).sum(axis=1) == N.DISTANCE + 1).all() and got.min() >= -1
    import itertools
    for q in range(40):
        price = lambda t: sum(costs[i][t[i]][values[i][q]] for i in range(4) if t[i] >= 0)
        best = min(price(t) for t in itertools.product(range(-1, 4), repeat=4) if sum(t) + 4 == 4)
        assert price(got[q]) == pytest.approx(best)
    near = N.near_counts(histograms[0], 16, 2)
    v = 777
    assert near[2][v] == sum(histograms[0][v ^ int(m)] for m in N.variants(16, 2))


def test_bits_are_dealt_once_and_by_correlation():
    together = np.eye(64)
    together[0, 40] = together[40, 0] = 0.9
    dealt = N.deal_bits(together, 3)
    assert sorted(b for part in dealt for b in part) == list(range(64)) and {len(p) for p in dealt} == {21, 22}
    assert 40 in dealt[0]


def test_components_of_a_long_path_and_a_star(spark):
    rng = random.Random(3)
    names = rng.sample(range(10_000), 400)
    path = list(zip(names[:200], names[1:200]))
    star = [(names[200], x) for x in names[201:]]
    edges = path + star + [(5, 5), path[0], path[0][::-1]]
    got = {r["u"]: r["root"] for r in components.connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {n: min(names[:200]) for n in names[:200]} | {n: min(names[200:]) for n in names[200:]}
    assert components.connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_a_crowd_of_near_copies_emits_few_rows(spark):
    """Two thousand fingerprints around one: a forest of links, not all pairs."""
    rng = random.Random(6)
    fps = {0} | {sum(1 << b for b in rng.sample(range(12), rng.randrange(1, 4))) << 8 * rng.randrange(3) for _ in range(1500)}
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    known = sorted(fps)
    pairs = sum((a ^ b).bit_count() <= 3 for i, a in enumerate(known) for b in known[:i])
    assert N.links(df).count() < pairs / 3
    marked = df.select(F.col("fp").alias("_cw_fp"), F.monotonically_increasing_id().alias("id"))
    assert N.components(marked, "id").select("root").distinct().count() == 1
