"""Canonical blocks out of an append-only event history; the delivery ordinal decides, never the time."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The first row of each key by ``order`` (columns or sort expressions)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def live_head(events: DataFrame) -> DataFrame:
    """For each height the block whose last event is no UNDO: the newest event of every (height, block), then the newest standing one.

    max_by keeps one row a key before the shuffle, so a long history of one height is no hot task.
    """
    rest = [c for c in events.columns if c not in ("block_num", "block_id")]
    last = events.groupBy("block_num", "block_id").agg(F.max_by(F.struct(*rest), "stream_ordinal").alias("e"))
    standing = last.where("e.fork_step <> 'UNDO'").select("block_num", "block_id", "e.*")
    rest = [c for c in standing.columns if c != "block_num"]
    return standing.groupBy("block_num").agg(F.max_by(F.struct(*rest), "stream_ordinal").alias("e")).select("block_num", "e.*")


def live_rows(child: DataFrame, head: DataFrame) -> DataFrame:
    """Child rows written by the events that stand (same height, block and ordinal)."""
    return child.join(head.select("block_num", "block_id", "stream_ordinal"), ["block_num", "block_id", "stream_ordinal"], "left_semi")


def skip_below(events: DataFrame, start: int) -> DataFrame:
    return events.where(F.col("block_num") >= start)
