"""Stored days: few large files in row order, with the rows proven unchanged."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from blockwright.operators.aggregates import row_before

# In-block order of the tables whose writer has one. A name with "?" stands for whether that column is set.
ROW_ORDER = {
    "blocks": [],
    "transactions": ["index"],
    "withdrawals": ["index"],
    "logs": ["block_index"],
    "access_lists": ["tx_index", "access_index"],
    "set_code_authorizations": ["tx_index", "authorization_index"],
    "calls": ["tx_index", "call_index"],
    "balance_changes": ["tx_index", "call_index", "ordinal"],
    "code_changes": ["tx_index", "call_index", "ordinal"],
    "storage_changes": ["tx_index", "call_index", "ordinal"],
    "nonce_changes": ["tx_index", "call_index", "ordinal"],
    "gas_changes": ["tx_index", "call_index", "ordinal"],
    "account_creations": ["tx_index", "call_index", "ordinal"],
    "system_calls": ["begin_ordinal"],
    "system_balance_changes": ["call_index?", "ordinal"],
    "system_code_changes": ["call_index?", "ordinal"],
    "system_storage_changes": ["call_index?", "ordinal"],
    "system_nonce_changes": ["call_index?", "ordinal"],
    "system_gas_changes": ["call_index?", "ordinal"],
    "system_account_creations": ["call_index?", "ordinal"],
    "fills": ["fill_index"],
    "funding_deltas": ["event_index", "delta_index"],
}


def row_order_key(table: str) -> list[Column]:
    """The columns that order a table's rows; a table without a known order is refused (KeyError) rather than ordered by its block alone."""
    return [F.col("block_num"), *[F.col(c[:-1]).isNotNull() if c.endswith("?") else F.col(c) for c in ROW_ORDER[table]]]


def file_report(df: DataFrame, target: int) -> DataFrame:
    """Files and bytes of each day, and how many files of ``target`` bytes they would fill."""
    f = df.select("date", F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_size").alias("b")).groupBy("date", "f").agg(F.max("b").alias("b"), F.count("*").alias("n"))
    return f.groupBy("date").agg(F.count("*").alias("files"), F.sum("b").alias("bytes"), F.sum("n").alias("rows"), F.count_if(F.col("b") < target).alias("small")).withColumn("wanted", F.ceil(F.col("bytes") / target))


def order_ties(df: DataFrame, key: list[str]) -> DataFrame:
    """Keys that more than one row has, so that no strict order exists."""
    return df.groupBy(*key).agg(F.count("*").alias("rows")).where("rows > 1")


def order_breaks(df: DataFrame, key: list[str | Column], file: str = "_metadata.file_path", row: str = "_metadata.row_index", width: int = 1 << 16) -> DataFrame:
    """Rows that don't come after the row before them in their file; ``width`` rows are looked through together, so that a large file is no single task."""
    names = [f"k{i}" if isinstance(c, Column) else c for i, c in enumerate(key)]
    k = F.struct(*[(c if isinstance(c, Column) else F.col(c)).alias(n) for c, n in zip(key, names, strict=True)])
    rows = df.select(k.alias("_k"), F.col(file).alias("_f"), F.col(row).alias("_r"))
    return row_before(rows, ["_f"], "_r", ["_k"], "_before", width).where("_before._k >= _k").select("_k.*")


def in_order(df: DataFrame, key: list[str | Column], files: int) -> DataFrame:
    """Rows of days in about ``files`` ranges of (date, key), sorted inside each (nulls first)."""
    order = [F.asc_nulls_first(c) if isinstance(c, str) else c.asc_nulls_first() for c in ("date", *key)]
    return df.repartitionByRange(files, *order).sortWithinPartitions(*order)


def compact_closed_dates(spark: SparkSession, root: str, table: str, out: str, dates: DataFrame, target: int = 128 << 20, key: list[str | Column] | None = None) -> DataFrame:
    """Rewrite the given closed days (a table of ``date``) into ``out``: large files in key order, all days in one job.

    Returns (date, rows) as read back. Raises, and leaves the source alone, if a day's count differs. The caller swaps the folders; this job only writes new files.
    """
    key = key or row_order_key(table)
    src = spark.read.parquet(f"{root}/{table}")
    closed = src.join(dates.select("date").distinct(), "date", "left_semi")
    report = file_report(src, target).join(dates.select("date").distinct(), "date", "left_semi")
    wanted = report.agg(F.sum("wanted")).first()[0]
    in_order(closed, key, max(1, wanted or 0)).write.partitionBy("date").option("compression", "zstd").parquet(f"{out}/{table}")
    done = spark.read.schema(src.schema).parquet(f"{out}/{table}").groupBy("date").agg(F.count("*").alias("rows"))
    both = report.select("date", F.col("rows").alias("before")).join(done.withColumnRenamed("rows", "after"), "date", "full_outer")
    wrong = both.where(~F.col("before").eqNullSafe(F.col("after"))).first()
    if wrong:
        raise RuntimeError(f"{table} {wrong['date']}: {wrong['before']} rows before, {wrong['after']} after")
    return done
