"""Connected components by alternating large-star and small-star steps (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blockwright.llm.shared import forget, written


def _smallest(edges: DataFrame) -> DataFrame:
    """(u, m): each node's smallest neighbour or itself."""
    return edges.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))


def _large_star(both: DataFrame, low: DataFrame) -> DataFrame:
    return both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """``edges`` point down (u > v), as the large star leaves them: a node has few."""
    low = _smallest(edges)
    joined = edges.join(low, "u")
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def components(edges: DataFrame, rounds: int = 100) -> DataFrame:
    """Rows (node, component) for every node of ``edges`` (u, v), component being the smallest node reachable.

    Self loops, repeated edges and nulls (left out) are allowed; no edges give no rows. Each round is written to the shared folder, its
    edge set and a checksum decide whether anything changed; rounds grow with the logarithm of the longest chain.
    Raises RuntimeError if ``rounds`` aren't enough, rather than give components in part.
    """
    now = written(edges.where("u <> v").select(F.greatest("u", "v").cast("long").alias("u"), F.least("u", "v").cast("long").alias("v")).distinct(), "edges")
    before = None
    for _ in range(rounds):
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            return now.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component")).union(now.select("v", "v").distinct())
        before, last = state, now
        both = last.union(last.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = written(_smallest(both), "smallest")  # a table of its own, so that the join of a hub's many edges with it can be split
        now = written(_small_star(_large_star(both, low)), "edges")
        forget(last, low)
    raise RuntimeError(f"components did not settle in {rounds} rounds")
