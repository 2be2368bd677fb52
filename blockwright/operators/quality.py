"""Continuity, coverage and consistency of blocks; every check gives the violating rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET = 100_000


def _with_previous(blocks: DataFrame, width: int = BUCKET, by: str | None = None) -> DataFrame:
    """Each block with the one before it (of its own part, with ``by``), without one window over all: windows inside ranges of heights, then one row a range.

    Columns: _num, _id, _time of the block before; of blocks at one height the smallest id comes first. _time is the last known time.
    """
    part = [by] if by else []
    keyed = blocks.withColumn("_bucket", F.floor(F.col("block_num") / width))
    w = Window.partitionBy(*part, "_bucket").orderBy("block_num", "block_id")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    row = F.struct("block_num", "block_id")
    inside = keyed.withColumns({"_prev": F.lag(row).over(w), "_seen": F.last("ts", ignorenulls=True).over(before)})
    edge = keyed.groupBy(*part, "_bucket").agg(F.max(row).alias("_end"), F.max_by("ts", F.when(F.col("ts").isNotNull(), row)).alias("_end_ts"))
    over = Window.partitionBy(*part).orderBy("_bucket")  # one row for each 100,000 heights
    edges = edge.select(*part, "_bucket", F.lag("_end").over(over).alias("_from"), F.last("_end_ts", ignorenulls=True).over(over.rowsBetween(Window.unboundedPreceding, -1)).alias("_from_ts"))
    both = inside.join(edges, [*part, "_bucket"], "left")
    previous = F.coalesce("_prev", "_from")
    return both.withColumns({"_num": previous["block_num"], "_id": previous["block_id"], "_time": F.coalesce("_seen", "_from_ts")}).drop("_bucket", "_prev", "_seen", "_from", "_from_ts")


def _problems(b: DataFrame, allow_gaps: bool, *keep: str) -> DataFrame:
    """Problems of rows that know the block before them (_num, _id, _time)."""
    num, prev = F.col("block_num"), F.col("_num")
    found = [F.when(num == prev, F.lit("duplicate"))]
    if not allow_gaps:
        found.append(F.when(num > prev + 1, F.lit("gap")))
    found += [F.when((num == prev + 1) & ~F.col("parent_id").eqNullSafe(F.col("_id")), F.lit("broken_parent")), F.when(F.col("ts") < F.col("_time"), F.lit("time_reversal"))]
    kinds = F.filter(F.array(*found), lambda k: k.isNotNull())
    out = b.select(*keep, F.explode(kinds).alias("kind"), "block_num", F.col("_num").alias("previous"))
    return out.withColumn("severity", F.when(F.col("kind") == "time_reversal", "warning").otherwise("error"))


def validate_blocks(blocks: DataFrame, allow_gaps: bool = False, width: int = BUCKET) -> DataFrame:
    """Problems of a block sequence (block_num, block_id, parent_id, ts in seconds, may be null): kind, block_num, previous, severity.

    gap: heights missing before; duplicate: a height again; broken_parent: parent isn't the block right before; time_reversal (a warning): earlier
    than the last known time, so unknown times neither hide nor fake one.
    """
    return _problems(_with_previous(blocks, width), allow_gaps)


SUMMARY = ["first_num", "first_id", "first_parent", "first_ts", "known_num", "known_prev", "known_ts", "last_num", "last_id", "last_ts", "blocks"]


def part_problems(blocks: DataFrame, by: str, allow_gaps: bool = False, width: int = BUCKET) -> DataFrame:
    """The problems inside each part (a day, a file) by itself: ``by``, kind, block_num, previous, severity."""
    return _problems(_with_previous(blocks, width, by), allow_gaps, by)


def part_summaries(blocks: DataFrame, by: str, width: int = BUCKET) -> DataFrame:
    """One row a part: what its neighbours need to know of it. Its first and last block, its first block of known time with the height before
    that one inside the part, its last known time, and how many blocks it has. Stored beside a day's files, it stands for the day from then on.
    """
    row = F.struct("block_num", "block_id")
    known = F.when(F.col("ts").isNotNull(), row)
    b = _with_previous(blocks, width, by)
    return b.groupBy(by).agg(
        F.min(row).alias("_f"), F.min_by("parent_id", row).alias("first_parent"), F.min_by("ts", row).alias("first_ts"), F.min(known).alias("_k"), F.min_by("_num", known).alias("known_prev"), F.min_by("ts", known).alias("known_ts"),
        F.max(row).alias("_l"), F.max_by("ts", known).alias("last_ts"), F.count("*").alias("blocks"),
    ).select(by, F.col("_f.block_num").alias("first_num"), F.col("_f.block_id").alias("first_id"), "first_parent", "first_ts", F.col("_k.block_num").alias("known_num"), "known_prev", "known_ts", F.col("_l.block_num").alias("last_num"), F.col("_l.block_id").alias("last_id"), "last_ts", "blocks")


def joined_problems(summaries: DataFrame, by: str, allow_gaps: bool = False) -> DataFrame:
    """Problems where parts meet, from their summaries alone: ``by`` (the later part), kind, block_num, previous, severity.

    With ``part_problems`` of every part they are what ``validate_blocks`` finds in all blocks. Parts whose heights interlock can't be told from
    summaries: the later one gives ``overlap``, and both must be read again together.
    """
    over = Window.orderBy("first_num", "first_id")  # one row a part
    earlier = over.rowsBetween(Window.unboundedPreceding, -1)
    ends = F.max(F.struct("last_num", "last_id")).over(earlier)
    s = summaries.withColumns({"_end": ends, "_time": F.last("last_ts", ignorenulls=True).over(earlier)})
    meets = F.col("_end") < F.struct(F.col("first_num").alias("last_num"), F.col("first_id").alias("last_id"))
    overlap = s.where(~meets).select(by, F.lit("overlap").alias("kind"), F.col("first_num").alias("block_num"), F.col("_end.last_num").alias("previous"), F.lit("error").alias("severity"))
    fine = s.where(meets)
    first = fine.select(by, F.col("first_num").alias("block_num"), F.col("first_parent").alias("parent_id"), F.lit(None).cast("long").alias("ts"), F.col("_end.last_num").alias("_num"), F.col("_end.last_id").alias("_id"), F.lit(None).cast("long").alias("_time"))
    late = fine.where("known_ts < _time").select(by, F.lit("time_reversal").alias("kind"), F.col("known_num").alias("block_num"), F.coalesce("known_prev", "_end.last_num").alias("previous"), F.lit("warning").alias("severity"))
    return overlap.unionByName(_problems(first, allow_gaps, by)).unionByName(late)


def merged_summary(summaries: DataFrame) -> DataFrame:
    """Parts that don't interlock as one part, in one row; in any grouping, as merging is associative. ``part`` isn't kept."""
    first, last = F.struct("first_num", "first_id"), F.struct("last_num", "last_id")
    known = F.when(F.col("known_num").isNotNull(), first)
    # the height before the first block of known time, where that begins its part, is the end of the part before
    before = summaries.withColumn("_end", F.lag("last_num").over(Window.orderBy("first_num", "first_id")))
    return before.withColumn("known_prev", F.coalesce("known_prev", F.when(F.col("known_num").isNotNull(), F.col("_end")))).agg(
        F.min("first_num").alias("first_num"), *[F.min_by(c, first).alias(c) for c in ("first_id", "first_parent", "first_ts")], *[F.min_by(c, known).alias(c) for c in ("known_num", "known_prev", "known_ts")],
        F.max("last_num").alias("last_num"), F.max_by("last_id", last).alias("last_id"), F.max_by("last_ts", F.when(F.col("last_ts").isNotNull(), last)).alias("last_ts"), F.sum("blocks").alias("blocks"))


def sealed_by_summaries(summaries: DataFrame, problems: DataFrame, start: int, stop: int) -> DataFrame:
    """What keeps parts from covering exactly [start, stop), from their summaries and all their problems, without reading a block. Empty: sealed."""
    ends = summaries.agg(F.min("first_num").alias("lo"), F.max("last_num").alias("hi"))
    return problems.where("severity = 'error'").select("kind", "block_num").unionByName(_ends(ends, start, stop))


def block_runs(blocks: DataFrame, width: int = BUCKET) -> DataFrame:
    """Unbroken runs of heights: first, last. A run's end is looked for inside its range of heights, then in the ranges after it, one row a range."""
    b = _with_previous(blocks.withColumn("ts", F.lit(None).cast("long")), width)
    starts = F.col("_num").isNull() | (F.col("block_num") > F.col("_num") + 1)
    begin = b.where(starts).select(F.col("block_num").alias("first"), F.col("_num").alias("_before"), F.floor(F.col("block_num") / width).alias("_bucket"))
    inside = begin.withColumn("_next", F.lead("_before").over(Window.partitionBy("_bucket").orderBy("first")))
    over = Window.orderBy("_bucket")  # one row for each range of heights
    edges = begin.groupBy("_bucket").agg(F.min_by("_before", "first").alias("_before")).select("_bucket", F.lead("_before").over(over).alias("_after"))
    top = blocks.agg(F.max("block_num")).first()[0]
    return inside.join(edges, "_bucket", "left").select("first", F.coalesce("_next", "_after", F.lit(top)).alias("last"))


def _ends(ends: DataFrame, start: int, stop: int) -> DataFrame:
    """Missing and foreign ends of one row (lo, hi) against [start, stop)."""
    kinds = F.array(F.when(F.col("lo").isNull() | (F.col("lo") > start), F.struct(F.lit("missing_start").alias("kind"), F.lit(start).cast("long").alias("block_num"))), F.when(F.col("lo") < start, F.struct(F.lit("below_start").alias("kind"), F.col("lo").alias("block_num"))),
                    F.when(F.col("hi").isNull() | (F.col("hi") < stop - 1), F.struct(F.lit("missing_end").alias("kind"), F.lit(stop - 1).cast("long").alias("block_num"))), F.when(F.col("hi") >= stop, F.struct(F.lit("beyond_end").alias("kind"), F.col("hi").alias("block_num"))))
    return ends.select(F.inline(F.filter(kinds, lambda k: k.isNotNull())))


def seal_range(blocks: DataFrame, start: int, stop: int, width: int = BUCKET) -> DataFrame:
    """What keeps ``blocks`` from covering exactly [start, stop): problems inside it, and missing or foreign ends. Empty: sealed."""
    inside = blocks.where((F.col("block_num") >= start) & (F.col("block_num") < stop))
    problems = validate_blocks(inside, width=width).where("severity = 'error'").select("kind", "block_num")
    return problems.unionByName(_ends(blocks.agg(F.min("block_num").alias("lo"), F.max("block_num").alias("hi")), start, stop))


def plan_lanes(spark, start: int, stop: int, width: int) -> DataFrame:
    lanes = spark.range((stop - start + width - 1) // width)
    return lanes.select(F.col("id").alias("lane"), (F.col("id") * width + start).alias("first"), F.least(F.col("id") * width + start + width, F.lit(stop)).alias("stop"))


def lane_progress(blocks: DataFrame, lanes: DataFrame, start: int, width: int) -> DataFrame:
    done = blocks.where(F.col("block_num") >= start).groupBy(F.floor((F.col("block_num") - start) / width).alias("lane")).agg(F.count_distinct("block_num").alias("done"), F.max("block_num").alias("newest"))
    return lanes.join(done, "lane", "left").withColumn("done", F.coalesce("done", F.lit(0))).withColumn("complete", F.col("done") == F.col("stop") - F.col("first"))


def count_disagreements(parents: DataFrame, child: DataFrame, keys: list[str], count: str) -> DataFrame:
    """Parents whose stored count isn't the number of their child rows."""
    n = child.groupBy(*keys).agg(F.count("*").alias("actual"))
    both = parents.select(*keys, F.col(count).alias("stored")).join(n, keys, "left").withColumn("actual", F.coalesce("actual", F.lit(0)))
    return both.where("stored <> actual")


def monitor(df: DataFrame, name: str, violated: Column | str, key: str = "fill_index") -> DataFrame:
    """Violations in the common form: monitor, block_num, key."""
    return df.where(violated).select(F.lit(name).alias("monitor"), F.col("block_num").cast("long").alias("block_num"), F.col(key).cast("string").alias("key"))


def all_monitors(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
