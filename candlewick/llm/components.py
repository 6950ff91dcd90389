"""Connected components of a large graph by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from candlewick.llm.common import joined_by_weight, staged


def _with_least(edges: DataFrame) -> DataFrame:
    """Edges (u, v) with the least of u and its partners. Nodes with many partners get theirs by broadcast, so that no task has them all."""
    least = edges.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("least"), F.count("*").alias("partners"))
    return joined_by_weight(edges, staged(least, "least"), ["u"], "partners")


def connected_components(edges: DataFrame) -> DataFrame:
    """(u, root) for every node of an edge (u, v), longs; the root is the least node reachable.

    Each round hangs a node's larger partners on its least one, then its smaller ones: a group's depth shrinks fast, and no node's
    partners are gathered in one task (a minimum with partial sums, then a join that does not shuffle the edges of nodes with many
    partners). Rounds are staged tables.
    """
    edges = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    edges, before = staged(edges, "edges"), None
    while True:
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == before:
            return edges.select("u", F.col("v").alias("root")).unionByName(
                edges.select(F.col("v").alias("u"), F.col("v").alias("root")).distinct())
        before = now
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = staged(_with_least(both).where("v > u").select(F.col("v").alias("u"), F.col("least").alias("v")).distinct(), "large")
        hung = _with_least(large)
        small = hung.select(F.col("v").alias("u"), F.col("least").alias("v")).where("u <> v") \
            .unionByName(hung.select("u", F.col("least").alias("v"))).distinct()
        edges = staged(small, "edges")
