"""Streams of blocks to tables: one micro-batch to all tables, exactly once after a restart."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from blockwright.operators.changelog import newest
from blockwright.operators.flatten import FlattenSpec, flatten
from blockwright.sources.tables import LAST_TABLE, children, stored_table, temporary_tables, writer_options
from blockwright.streaming.state import States


def write_batch(tables: dict[str, DataFrame], root: str, batch_id: int) -> None:
    """Each table's rows of a batch go to that batch's folder, which a replay overwrites; ``blocks`` last."""
    for name in sorted(tables, key=lambda n: (n == LAST_TABLE, n)):
        df = tables[name]
        parts = ["date"] if "date" in df.columns else []
        df.write.mode("overwrite").options(**writer_options()).partitionBy(*parts).parquet(f"{root}/{name}/batch_id={batch_id}")


def ingest_stream(source: DataFrame, spec: FlattenSpec, root: str, checkpoint: str, before: Callable[[DataFrame, int], DataFrame] | None = None, available_now: bool = True) -> StreamingQuery:
    """Flatten every micro-batch into all tables of the family. The checkpoint replays an unfinished batch under its own id."""
    def write(batch: DataFrame, batch_id: int) -> None:
        with temporary_tables(batch.sparkSession):
            rows = before(batch, batch_id) if before else batch
            if spec.errors is not None:  # checked once, not once a table
                rows = rows.withColumn("_errors", spec.errors if isinstance(spec.errors, Column) else F.expr(spec.errors))
            rows = rows.persist()
            try:
                write_batch(flatten(rows, spec), root, batch_id)
            finally:
                rows.unpersist()

    stream = source.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (stream.trigger(availableNow=True) if available_now else stream).start()


def assign_ordinal(batch: DataFrame, order: list[str], after: int) -> DataFrame:
    """Strictly increasing stream_ordinal in delivery order, from ``after`` + 1 on.

    Sorted ranges are stored with each row's range and place in it, so that a replayed task can't number them differently; then their sizes are added up.
    """
    ranged = batch.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id())
    fixed = stored_table(ranged.select(*batch.columns, F.shiftright("_id", 33).alias("_p"), F.col("_id").bitwiseAND((1 << 33) - 1).alias("_i")), "ordinals")
    sizes = fixed.groupBy("_p").agg(F.count("*").alias("_n"))
    before = sizes.select("_p", (F.sum("_n").over(Window.orderBy("_p")) - F.col("_n")).alias("_before"))  # one row a range
    return fixed.join(F.broadcast(before), "_p").withColumn("stream_ordinal", F.col("_before") + F.col("_i") + 1 + after).drop("_p", "_i", "_before")


def live_head_stream(events: DataFrame) -> DataFrame:
    """The last event of every (height, block), kept up to date; standing ones have fork_step other than UNDO."""
    rest = [c for c in events.columns if c not in ("block_num", "block_id")]
    return events.groupBy("block_num", "block_id").agg(F.max_by(F.struct(*rest), "stream_ordinal").alias("e")).select("block_num", "block_id", "e.*")


def changelog_writer(root: str, key: list[str], append: Callable[[DataFrame, DataFrame], DataFrame], schema, run: str | None = None) -> Callable[[DataFrame, int], None]:
    """For foreachBatch over snapshots: only changes against the log so far are written, to ``run=R/batch=K`` under ``root``.

    R is the streaming query's id, which its checkpoint keeps: a replayed batch overwrites its own rows, and a query with a new checkpoint goes
    on after the log it finds. The state, each entity's newest row, is all that a batch reads: ``_newest/N-R-K``, which readers of the log
    pass over; N counts on from the newest whole state, and the last two are kept. Without any state the log itself gives it. One writer a root at a time.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        states = States(spark, f"{root}/_newest", batch_id, run)
        if states.base:
            before = spark.read.schema(schema).parquet(states.base)
        elif not states.replayed and children(spark, root):
            log = spark.read.schema(schema).parquet(root)  # its states are gone; what an unfinished write of this batch left doesn't count
            others = ~((F.col("run").cast("string") == states.run) & (F.col("batch").cast("long") == batch_id)) if "run" in log.columns else F.lit(True)
            before = newest(log.where(others).select(*schema.fieldNames()), key)
        else:
            before = spark.createDataFrame([], schema)
        place = f"{root}/run={states.run}/batch={batch_id}"
        append(before, batch).write.mode("overwrite").parquet(place)
        added = spark.read.schema(schema).parquet(place)
        states.write(newest(before.unionByName(added), key))

    return write


def day_router(root: str, write: Callable[[DataFrame, int], None], schema, run: str | None = None) -> Callable[[DataFrame, int], None]:
    """For foreachBatch over blocks in order: each batch goes to ``write`` with the day ``routing_day`` gives its blocks in the whole stream.

    The last known time is carried from batch to batch. Blocks before the first known time of all are held until it comes, and go out in that
    batch. State (the last known time, held blocks) lies under ``root/_days``; a restart or a replay goes on as if nothing had happened.
    """
    def routed(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        states = States(spark, f"{root}/_days", batch_id, run)
        shape = F.lit(None).cast("timestamp").alias("_anchor")
        held, anchor = spark.createDataFrame([], schema), None
        if states.base:
            state = spark.read.schema(spark.createDataFrame([], schema).select("*", shape, F.lit(True).alias("_held")).schema).parquet(states.base)
            held, anchor = state.where("_held").select(*held.columns), state.agg(F.max("_anchor")).first()[0]
        rows = held.unionByName(batch.select(*held.columns))
        last = rows.where("ts IS NOT NULL").agg(F.max_by("ts", "block_num")).first()[0]
        known = last if last is not None else anchor
        if known is not None:
            write(routing_day(rows, anchor=anchor), batch_id)
            blank = spark.createDataFrame([], schema)
            mark = spark.range(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in blank.schema], F.lit(known).cast("timestamp").alias("_anchor"), F.lit(False).alias("_held"))
            states.write(mark)
        else:
            states.write(rows.select("*", shape, F.lit(True).alias("_held")))

    return routed


def routing_day(blocks: DataFrame, seed: str | None = None, width: int = 100_000, anchor=None) -> DataFrame:
    """Each block's day from its own time, else the last known time before it (``anchor``: one before all of them), else the first known after it, else ``seed``.

    Windows stay inside ranges of heights; between ranges only one row each is carried on.
    """
    keyed = blocks.withColumn("_bucket", F.floor(F.col("block_num") / width))
    w = Window.partitionBy("_bucket").orderBy("block_num")
    inside = keyed.withColumns({"_known": F.last("ts", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)), "_later": F.first("ts", ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing))})
    at = F.when(F.col("ts").isNotNull(), F.col("block_num"))
    ends = keyed.groupBy("_bucket").agg(F.max_by("ts", at).alias("_last"), F.min_by("ts", at).alias("_first"))
    over = Window.orderBy("_bucket")  # one row for each range of heights
    ends = ends.select("_bucket", F.last("_last", ignorenulls=True).over(over.rowsBetween(Window.unboundedPreceding, -1)).alias("_before"), F.first("_first", ignorenulls=True).over(over.rowsBetween(1, Window.unboundedFollowing)).alias("_after"))
    out = inside.join(ends, "_bucket", "left")
    day = F.to_date(F.coalesce("_known", "_before", F.lit(anchor).cast("timestamp"), "_later", "_after", F.lit(seed).cast("timestamp")))
    return out.withColumn("date", day).drop("_bucket", "_known", "_later", "_before", "_after")


def observed(df: DataFrame, name: str) -> DataFrame:
    """Rows, newest block and lag of every batch as metrics of the query."""
    return df.observe(name, F.count(F.lit(1)).alias("rows"), F.max("block_num").alias("latest_block"), F.max(F.unix_timestamp("timestamp")).alias("latest_seconds"))


class TableMetrics(StreamingQueryListener):
    """Keeps the newest observed metrics of every table."""

    def __init__(self):
        self.tables: dict[str, dict] = {}

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        for name, row in (event.progress.observedMetrics or {}).items():
            self.tables[name] = row.asDict()

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass
