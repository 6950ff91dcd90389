"""SimHash near-duplicates: fingerprints of 64 bits, linked when at most three bits differ, by a generalised pigeonhole.

Fingerprint: a bit is 1 if it is set in more than half of the hashes of the text's three-word shingles. All later work is on
distinct fingerprints, so exact copies cost one row.

Search: the 64 bits are dealt into ``parts``, correlated bits together. If a query's parts get thresholds t with sum(t + 1) = 4
(t = -1: part not probed), any fingerprint within 3 bits differs by at most t in some part. The thresholds are chosen for each
query by dynamic programming over the parts, on the numbers of fingerprints near its part values (exact counts of every part value;
the table has a fixed size). Probes and index meet in a hash join by (part, value), where pairs are verified. The pigeonhole
holds for each query alone, so only the smaller fingerprint of a pair needs to find the larger.

A value with more than ``CROWD`` fingerprints goes another way: its probes and members are dealt into blocks, each pair of blocks is one
group that is compared in numpy and gives a spanning forest of its links, never all pairs. No pair is left out by either way.
Links go to ``connected_components``; a document's component is the smallest id reachable.

Texts without words have fingerprint 0 and are linked like any other. Null ids are passed by when the smallest is taken; repeated
rows fall into one component.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from candlewick.llm.common import batch_of, chunks, staged, table
from candlewick.llm.components import connected_components

BITS = 64
DISTANCE = 3
SHINGLE = 3
SEED = 42
#: Distinct fingerprints up to which four, then three parts are used; then two.
FOUR_PARTS, THREE_PARTS = 1 << 19, 1 << 26
CROWD = 64
BLOCK = 2048
#: A probe costs as much as this many comparisons.
PROBE_COST = 2
#: A comparison within a crowd costs this share of another: it emits no pair.
CROWD_COST = 0.1


def shingle_hashes(text: bytes | None) -> np.ndarray:
    """XXH64 of every run of three words; of the whole sequence if there are fewer."""
    words = (text or b"").lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    joined = memoryview(b" ".join(words))
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    begins = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - SHINGLE + 1)
    last = ends[min(SHINGLE, len(words)) - 1:]
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[b:e], SEED) for b, e in zip(begins[:n].tolist(), last.tolist())), dtype=np.uint64, count=n)


def bit_counts(hashes: np.ndarray, most: int = 1 << 18) -> np.ndarray:
    """How many hashes have each bit."""
    total = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), most):
        part = np.ascontiguousarray(hashes[at:at + most])
        total += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return total


def fingerprints(texts: list[bytes | None]) -> np.ndarray:
    """Signed 64-bit fingerprints."""
    hashes = [shingle_hashes(t) for t in texts]
    counts = np.stack([bit_counts(h) for h in hashes]) if hashes else np.zeros((0, BITS), np.int64)
    ones = counts * 2 > np.array([len(h) for h in hashes], dtype=np.int64)[:, None]
    return np.packbits(ones, axis=1, bitorder="little").view(np.uint64).reshape(-1).astype(np.uint64).view(np.int64)


def with_fingerprint(df: DataFrame, text: str = "text", name: str = "_cw_fp") -> DataFrame:
    """``df`` with the column ``name``."""
    schema = df.withColumn(name, F.lit(0).cast("long")).schema

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text)).cast(pa.binary()).to_pylist()
            found = [fingerprints(texts[b:e]) for b, e in chunks([t or b"" for t in texts])]
            values = np.concatenate(found) if found else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(values, pa.int64())], names=[*batch.schema.names, name])

    return df.mapInArrow(marked, schema)


def as_bits(fps: np.ndarray) -> np.ndarray:
    return np.unpackbits(np.ascontiguousarray(fps).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def deal_bits(together: np.ndarray, parts: int) -> list[list[int]]:
    """Bits in ``parts`` groups of even size: each starts with the first free bit and takes those most correlated with its own."""
    free, dealt = list(range(BITS)), []
    for left in range(parts, 0, -1):
        size, own = len(free) // left + (len(free) % left > 0), [free.pop(0)]
        while len(own) < size:
            best = max(free, key=lambda b: (together[b, own].sum(), -b))
            free.remove(best)
            own.append(best)
        dealt.append(own)
    return dealt


def correlation(fps: DataFrame) -> np.ndarray:
    """Absolute correlation of each two bits over all fingerprints; a fixed number of sums leaves each task."""
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, n = np.zeros((BITS + 1, BITS + 1), dtype=np.int64), 0
        for batch in batches:
            bits = as_bits(batch.column(0).to_numpy(zero_copy_only=False))
            bits = np.hstack([bits, np.ones((len(bits), 1), np.uint8)]).astype(np.float32)
            for at in range(0, len(bits), 1 << 16):
                both += np.rint(bits[at:at + (1 << 16)].T @ bits[at:at + (1 << 16)]).astype(np.int64)
            n += len(bits)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(both.size)), pa.array(both.ravel())], names=["cell", "n"])

    rows = fps.select("fp").mapInArrow(sums, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    both = np.zeros((BITS + 1) ** 2)
    both[rows["cell"].to_numpy()] = rows["n"].to_numpy()
    both = both.reshape(BITS + 1, BITS + 1)
    n, ones = max(both[-1, -1], 1), both[-1, :-1]
    cov = both[:-1, :-1] / n - np.outer(ones / n, ones / n)
    spread = np.sqrt(np.maximum(np.diag(cov), 1e-12))
    return np.abs(cov / np.outer(spread, spread))


def part_values(bits: np.ndarray, part: list[int]) -> np.ndarray:
    return bits[:, part].astype(np.int64) @ (1 << np.arange(len(part), dtype=np.int64))


def near_counts(histogram: np.ndarray, width: int, most: int) -> list[np.ndarray]:
    """For t = 0..most: how many fingerprints have a part value within t bits of each value (or the sum of their weights)."""
    at = [histogram.astype(np.float64)] + [np.zeros(len(histogram)) for _ in range(most)]
    for bit in range(width):
        turned = [x.reshape(-1, 2, 1 << bit)[:, ::-1].reshape(-1) for x in at[:-1]]
        for k in range(most, 0, -1):
            at[k] = at[k] + turned[k - 1]
    return list(np.cumsum(at, axis=0))


def variants(width: int, t: int) -> np.ndarray:
    """Masks of at most t bits."""
    return np.array([sum(1 << b for b in c) for k in range(t + 1) for c in combinations(range(width), k)], dtype=np.int64)


@dataclass(frozen=True)
class Plan:
    """How bits are dealt, the counts of part values, and the cost of each (part, threshold, value); no tables: two wide parts."""

    parts: list[list[int]]
    histograms: list[np.ndarray] | None
    costs: list[list[np.ndarray]] | None  # [part][t]
    most: int  # largest threshold


def allocate(plan: Plan, values: list[np.ndarray]) -> np.ndarray:
    """Thresholds (queries x parts), -1 for parts not probed: the cheapest with sum(t + 1) = DISTANCE + 1."""
    n, budget = len(values[0]), DISTANCE + 1
    if plan.costs is None:
        return np.tile(np.array([budget // 2 - 1, budget - budget // 2 - 1]), (n, 1))
    best = np.full((budget + 1, n), np.inf)
    best[0] = 0
    steps = []
    for costs, own in zip(plan.costs, values):
        new, step = best.copy(), np.zeros((budget + 1, n), dtype=np.int64)
        for t, cost in enumerate(costs):
            price = cost[own]
            for j in range(budget, t, -1):
                total = best[j - t - 1] + price
                better = total < new[j]
                new[j] = np.where(better, total, new[j])
                step[j] = np.where(better, t + 1, step[j])
        best = new
        steps.append(step)
    out, left = np.zeros((n, len(values)), dtype=np.int64), np.full(n, budget)
    for i in range(len(values) - 1, -1, -1):
        taken = steps[i][left, np.arange(n)]
        out[:, i] = taken - 1
        left = left - taken
    return out


def make_plan(fps: DataFrame, n: int) -> Plan:
    parts = 4 if n <= FOUR_PARTS else 3 if n <= THREE_PARTS else 2
    dealt = deal_bits(correlation(fps), parts)
    if parts == 2:
        return Plan(dealt, None, None, 1)
    most = 3 if parts == 4 else 1

    def valued(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = as_bits(batch.column(0).to_numpy(zero_copy_only=False))
            for i, part in enumerate(dealt):
                values, counts = np.unique(part_values(bits, part), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(values), i, np.int32)), pa.array(values), pa.array(counts)],
                                                 names=["part", "value", "n"])

    found = fps.select("fp").mapInArrow(valued, "part int, value long, n long").groupBy("part", "value").agg(
        F.sum("n").cast("int").alias("n"))
    histograms = [np.zeros(1 << len(part), dtype=np.int32) for part in dealt]
    for i, part in enumerate(dealt):  # at most 2 ** 22 rows each, whatever the size of the input
        rows = found.where(F.col("part") == i).select("value", "n").toArrow()
        histograms[i][rows["value"].to_numpy()] = rows["n"].to_numpy()
    costs = []
    for part, histogram in zip(dealt, histograms):
        near = near_counts(np.where(histogram > CROWD, histogram * CROWD_COST, histogram), len(part), most)
        costs.append([(c + PROBE_COST * len(variants(len(part), t))).astype(np.float32) for t, c in enumerate(near)])
    return Plan(dealt, histograms, costs, most)


_KEYS = pa.schema([("part", pa.int32()), ("value", pa.int64()), ("fp", pa.int64()), ("probe", pa.bool_()), ("crowd", pa.int32())])


def keys(fps: DataFrame, plan: Plan) -> DataFrame:
    """Index rows and probes (part, value, fp, probe, crowd: members of that value if crowded, else 0)."""
    shared = fps.sparkSession.sparkContext.broadcast(
        (plan.parts, plan.histograms, plan.costs, plan.most))

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = Plan(*shared.value)
        masks = [[variants(len(part), t) for t in range(plan.most + 1)] for part in plan.parts]

        def rows(i: int, values: np.ndarray, own: np.ndarray, probe: bool, least: np.ndarray | int) -> pa.RecordBatch:
            if plan.histograms is None:
                crowd = np.zeros(len(values), np.int32)
            else:
                crowd = plan.histograms[i][values]
                use = crowd > least  # no member but the fingerprint itself: nothing to meet
                values, own, crowd = values[use], own[use], crowd[use]
                crowd = np.where(crowd > CROWD, crowd, 0).astype(np.int32)
            return batch_of(_KEYS, [np.full(len(values), i, np.int32), values, own, np.full(len(values), probe), crowd])

        for batch in batches:
            for at in range(0, len(batch), 20_000):
                fp = batch.column(0).slice(at, 20_000).to_numpy(zero_copy_only=False)
                bits = as_bits(fp)
                values = [part_values(bits, part) for part in plan.parts]
                thresholds = allocate(plan, values)
                for i, own in enumerate(values):
                    yield rows(i, own, fp, False, 0)
                    for t in range(plan.most + 1):
                        at_t = np.flatnonzero(thresholds[:, i] == t)
                        for mask in masks[i][t] if len(at_t) else ():
                            yield rows(i, own[at_t] ^ mask, fp[at_t], True, int(mask == 0))

    return fps.select("fp").mapInArrow(keyed, "part int, value long, fp long, probe boolean, crowd int")


def forest(probes: np.ndarray, members: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (node, root) that connect what links between probes and members within DISTANCE connect."""
    nodes, where = np.unique(np.concatenate([probes, members]), return_inverse=True)
    p, m = where[:len(probes)], where[len(probes):]
    label = np.arange(len(nodes))
    q, d = nodes.view(np.uint64)[p], nodes.view(np.uint64)[m]
    links = []
    for at in range(0, len(q), 256):
        a, b = np.nonzero(np.bitwise_count(q[at:at + 256, None] ^ d[None, :]) <= DISTANCE)
        a, b = p[a + at], m[b]
        use = a != b
        links.append((a[use], b[use]))
    a, b = (np.concatenate(x) for x in zip(*links)) if links else (np.zeros(0, int), np.zeros(0, int))
    while len(a):
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if (label == before).all():
            break
    moved = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[moved], nodes[label[moved]]


def crowded_links(rows: DataFrame) -> DataFrame:
    """Links through crowded values: blocks against blocks."""
    blocks = F.ceil(F.col("crowd") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("fp"), blocks).cast("int")
    other = F.explode(F.sequence(F.lit(0), blocks - 1))
    dealt = rows.where("crowd > 0").select("part", "value", "fp", "probe", own.alias("own"), other.alias("other")).select(
        "part", "value", "fp", "probe", F.when(F.col("probe"), F.col("own")).otherwise(F.col("other")).alias("a"),
        F.when(F.col("probe"), F.col("other")).otherwise(F.col("own")).alias("b"))

    def linked(pdf: pd.DataFrame) -> pd.DataFrame:
        fp, probe = pdf["fp"].to_numpy(), pdf["probe"].to_numpy()
        u, v = forest(np.unique(fp[probe]), fp[~probe])
        return pd.DataFrame({"u": u, "v": v})

    return dealt.groupBy("part", "value", "a", "b").applyInPandas(linked, "u long, v long")


def links(fps: DataFrame) -> DataFrame:
    """Pairs (u, v) of distinct fingerprints that connect everything within DISTANCE bits."""
    n = fps.count()
    rows = staged(keys(fps, make_plan(fps, n)), "keys")
    probes = rows.where("probe and crowd = 0").select("part", "value", F.col("fp").alias("u"))
    index = rows.where("not probe and crowd = 0").select("part", "value", F.col("fp").alias("v"))
    met = probes.join(index, ["part", "value"]).where(
        (F.col("u") < F.col("v")) & (F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= DISTANCE)).select("u", "v")
    return met.unionByName(crowded_links(rows)).distinct()


def components(marked: DataFrame, id_column: str, fp: str = "_cw_fp") -> DataFrame:
    """(fp, root, component_id) of every distinct fingerprint in ``marked``; the root tells components apart."""
    fps = staged(marked.groupBy(F.col(fp).alias("fp")).agg(F.min(id_column).alias("least")), "fingerprints")
    roots = staged(connected_components(links(fps)), "roots")
    rooted = fps.join(roots, fps["fp"] == roots["u"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rooted.join(smallest, "root").select(F.col("fp").alias(fp), "root", "component_id")


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprint and component of every document."""
    slim = docs.select(F.col(id_column).alias("id"), F.col(text).alias("text"))
    marked = staged(with_fingerprint(slim).select("id", "_cw_fp"), "marked")
    return marked.join(components(marked, "id"), "_cw_fp", "left").select(
        F.col("id").alias(id_column), F.lower(F.lpad(F.hex("_cw_fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each component, the one with the smallest id (of repeated rows, one), with all columns."""
    marked = staged(with_fingerprint(docs, text).withColumn("_cw_row", F.monotonically_increasing_id()), "marked")
    slim = marked.select(F.col(f"`{id_column}`").alias("id"), "_cw_fp", "_cw_row")
    # Each step keys by fingerprint with partial sums, by distinct fingerprint or by row, so a group of copies meets in no task.
    place = F.struct(F.col("id").isNull().alias("none"), "id", "_cw_row")
    first_of_fp = slim.groupBy("_cw_fp").agg(F.min(place).alias("place"))
    first = first_of_fp.join(components(slim, "id"), "_cw_fp").groupBy("root").agg(F.min("place").alias("place"))
    others = slim.select("_cw_row").join(first.select("place._cw_row"), "_cw_row", "left_anti").withColumnRenamed("_cw_row", "_cw_other")
    return marked.join(staged(others, "copies"), F.col("_cw_row") == F.col("_cw_other"), "left_anti").select(
        *(F.col(f"`{c}`") for c in docs.columns))


def op10_simhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
