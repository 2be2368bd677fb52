"""State of a foreachBatch writer as small tables beside what it writes: numbered, whole or ignored, the last two kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from blockwright.sources.tables import children, remove


class States:
    """``N-RUN-BATCH`` folders under ``root``. N counts on from the newest whole state, whoever wrote it; RUN is the streaming query's id, which its
    checkpoint keeps. A replayed batch starts again from the state before its own; a query with a new checkpoint from the newest. One writer at a time.
    """

    def __init__(self, spark: SparkSession, root: str, batch_id: int, run: str | None = None):
        self.spark, self.root = spark, root
        self.run = run or spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "manual"
        self.whole = sorted((int(n.split("-", 1)[0]), n) for n in children(spark, root) if "_SUCCESS" in children(spark, f"{root}/{n}"))
        own = next((n for n, name in self.whole if name == f"{n}-{self.run}-{batch_id}"), None)
        self.replayed = own is not None
        base = [(n, name) for n, name in self.whole if own is None or n < own]
        self.base = f"{root}/{base[-1][1]}" if base else None
        self.number = base[-1][0] + 1 if base else 0
        self.path = f"{root}/{self.number}-{self.run}-{batch_id}"

    def write(self, state: DataFrame) -> None:
        state.write.mode("overwrite").parquet(self.path)
        for n, name in self.whole:
            if n < self.number - 1:
                remove(self.spark, f"{self.root}/{name}")
