"""Connected components of an undirected graph, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import stage


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Point neighbours at the least neighbour: the greater ones (large star) or the others (small star)."""
    if large:
        near = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        near = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = near.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    found = near.join(least, "a")
    if large:
        out = found.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = found.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        out = out.union(least.where("a <> m").select("a", F.col("m").alias("b")))
    return out.where("a <> b").distinct()


def components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """node, component (the least node id reachable) of every node with an edge. edges: a, b.

    Each round is written to the shared folder. Rounds grow with the logarithm of the longest path; a node's
    neighbours are never gathered, only their minimum is taken, in partial aggregates.
    """
    now = stage(edges.select("a", "b").where("a <> b").distinct(), "edges")
    before = None
    for _ in range(max_rounds):
        now = stage(_star(_star(now, True), False), "edges")
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == before:
            leaves = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
            return leaves.union(now.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
        before = mark
    raise RuntimeError("the components did not settle")
