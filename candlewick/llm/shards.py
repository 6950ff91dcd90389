"""Sharding along a Hilbert curve: documents that are alike in several metadata columns end up in the same files.

Each dimension is quantised at its quantiles (texts by their whole values, weighted by rows; sizes by their logarithm), the cell
gets its index on the Hilbert curve, rows are sorted by that index and the sorted run is cut into shards of equal row counts (law
``rows``: counts differ by one at most). Neighbouring cells of the curve are neighbours in every dimension, so a file's minimum and
maximum are narrow in each of them and readers can skip files by any.

A text has one cell, that of its smallest id (null first, then the smallest index), and ties go by size, text, then id: equal texts
lie side by side, and a group of them is in more than one shard only where a cut of the law falls into it. Null text has no bytes
(size 1, crc32 0), null metadata is the lowest cell, an empty table gives no rows, repeated rows all get slots of their own. Only
the named columns are read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from candlewick.llm.common import joined_by_weight, staged, table, text_key

#: Bits for each dimension: 2 ** BITS cells, cut at quantiles.
BITS = 5
SHARDS = 16


def hilbert_index(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Index on the Hilbert curve of each row of ``cells`` (rows x dimensions, each below 2 ** bits).

    The published transposed form (Skilling 2004): undo the rotations from the highest bit down, Gray-code, interleave the bits.
    """
    x = cells.astype(np.int64).T.copy()
    dims = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for i in range(dims):
            turned = (x[i] & q) != 0
            swap = np.where(turned, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(turned, low, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        flip ^= np.where((x[dims - 1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= flip
    index = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(dims):
            index = (index << 1) | ((x[i] >> bit) & 1)
    return index


def text_edges(df: DataFrame, column: str, bits: int = BITS) -> list[str]:
    """At most 2 ** bits - 1 values of a text column that cut its rows into parts of about equal weight, ascending in byte order.

    Values are counted, the distinct ones are sorted over ranges, and weights are summed within each range and over the ranges.
    """
    counted = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    values = staged(counted.repartitionByRange("value").withColumn("part", F.spark_partition_id()), "values")
    sizes = values.groupBy("part").agg(F.sum("n").alias("n"))
    total = sizes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    begins = sizes.select("part", F.coalesce(F.sum("n").over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("begin"))
    within = F.sum("n").over(Window.partitionBy("part").orderBy("value").rowsBetween(Window.unboundedPreceding, 0))
    ends = values.withColumn("within", within).join(F.broadcast(begins), "part").withColumn("end", F.col("begin") + F.col("within"))
    cells = lambda rows: F.floor(rows * F.lit(1 << bits) / F.lit(max(total, 1)))
    return [r["value"] for r in ends.where(cells(F.col("end")) > cells(F.col("end") - F.col("n"))).select("value").orderBy("value").collect()
            ][:(1 << bits) - 1]


def as_number(df: DataFrame, column: str, bits: int = BITS) -> Column:
    """A number in the order of the column: for texts the number of ``text_edges`` below the value, -1 for null."""
    if df.schema[column].dataType.typeName() == "string":
        below = [F.when(F.col(column) > F.lit(edge), 1).otherwise(0) for edge in text_edges(df, column, bits)]
        return F.when(F.col(column).isNull(), -1.0).otherwise(sum(below, F.lit(0)).cast("double"))
    return F.coalesce(F.col(column).cast("double"), F.lit(-1.0))


def hilbert_order(df: DataFrame, numbers: list[Column], bits: int = BITS) -> DataFrame:
    """``df`` with column ``curve``. Quantiles come from one aggregation over all rows, of constant size."""
    names = [f"n{i}" for i in range(len(numbers))]
    coded = df.select("*", F.array(*numbers).alias("numbers"))
    steps = [k / (1 << bits) for k in range(1, 1 << bits)]
    cuts = coded.select(*(F.percentile_approx(F.col("numbers")[i], steps, 10_000).alias(n) for i, n in enumerate(names))).first()
    edges = [np.array(sorted(set(cuts[n] or []))) for n in names]

    @F.pandas_udf("long")
    def curve(numbers: pd.Series) -> pd.Series:
        rows = np.stack(numbers.to_list()) if len(numbers) else np.zeros((0, len(edges)))
        cells = np.stack([np.searchsorted(e, rows[:, i]) for i, e in enumerate(edges)], axis=1)
        return pd.Series(hilbert_index(cells, bits))

    return coded.withColumn("curve", curve("numbers")).drop("numbers")


def ranked(df: DataFrame, *order: str) -> tuple[DataFrame, int]:
    """``df`` with ``rank``, its place in the order from 0, and the number of rows.

    Range-partitioned and sorted, so a hot value spreads over tasks as long as the whole order differs; the places where the
    ranges begin are summed over one row for each range.
    """
    placed = staged(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(
        "place", F.monotonically_increasing_id()), "ranked")
    part = F.shiftright("place", 33)
    sizes = placed.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    total = sizes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    begins = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("begin"))
    at = placed.withColumn("part", part).join(F.broadcast(begins), "part")
    return at.withColumn("rank", F.col("begin") + F.col("place").bitwiseAND((1 << 33) - 1)).drop("part", "begin", "place"), total


def cut(rank: Column, total: int, shards: int) -> tuple[Column, Column]:
    """Shard and slot of a rank: the first ``total % shards`` shards hold one row more."""
    low, more = divmod(total, shards)
    edge = more * (low + 1)
    rank, small, large = rank.cast("long"), F.lit(max(low, 1)), F.lit(low + 1)
    shard = F.when(rank < edge, F.floor(rank / large)).otherwise(more + F.floor((rank - edge) / small))
    slot = F.when(rank < edge, rank % large).otherwise((rank - edge) % small)
    return shard.cast("int"), slot.cast("long")


def shard_documents(docs: DataFrame, shards: int = SHARDS, dimensions: tuple[str, ...] = ("source", "lang"),
                    id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Id, size, text_crc32, law, shard and slot of every document."""
    body = F.coalesce(F.col(text).cast("binary"), F.lit(b""))
    slim = docs.select(F.col(id_column).alias("id"), text_key(text).alias("text_key"), *(as_number(docs, d).alias(f"d{i}") for i, d in enumerate(dimensions)),
                       (F.octet_length(body) + 1).cast("long").alias("size"), F.crc32(body).alias("text_crc32")).withColumn("row", F.monotonically_increasing_id())
    numbers = [F.col(f"d{i}") for i in range(len(dimensions))] + [F.log2("size")]
    placed = hilbert_order(staged(slim, "sizes"), numbers).select("id", "text_key", "size", "text_crc32", "row", "curve")
    placed = staged(placed, "cells")
    cells = placed.groupBy("text_key").agg(F.min(F.struct("id", "curve")).alias("first"), F.count("*").alias("copies")) \
        .select("text_key", F.col("first.curve").alias("curve"), "copies")
    at = joined_by_weight(placed.drop("curve"), staged(cells, "text-cells"), ["text_key"], "copies")
    rows, total = ranked(at, "curve", "size", "text_key", "id", "row")
    shard, slot = cut(F.col("rank"), total, shards)
    return rows.select(F.col("id").alias(id_column), "size", "text_crc32", F.lit("rows").alias("law"), shard.alias("shard"),
                       slot.alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "curve")


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, dimensions: tuple[str, ...] = ("source", "lang"),
                 id_column: str = "doc_id", text: str = "text") -> None:
    """Write whole documents as ``shard=N`` folders in curve order. Ids must be unique and not null."""
    at = shard_documents(docs, shards, dimensions, id_column, text).select(id_column, "shard", "slot")
    docs.join(at, id_column).repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").drop("slot") \
        .write.partitionBy("shard").parquet(path)


def op9_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"))
