"""Column sets and types shared by all tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

AMOUNT = "decimal(38,10)"

CANONICAL = T.StructType([
    T.StructField("block_num", T.LongType(), False),
    T.StructField("block_id", T.StringType(), False),
    T.StructField("parent_num", T.LongType()),
    T.StructField("parent_id", T.StringType()),
    T.StructField("lib_num", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
])
IDENTITY = [f.name for f in CANONICAL]
EVENT_HISTORY = ["fork_step", "stream_ordinal"]

SESSION = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.decimalOperations.allowPrecisionLoss": "false",
    "spark.sql.adaptive.enabled": "true",
    # Partitions follow bytes: rows of a few bytes each in a shuffle take tenfold or more in a sort, so that 64 MB (the default) are near a gigabyte in a task.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m",
}
#: Partitions that a shuffle starts from, before small ones are joined, whatever ``spark.sql.shuffle.partitions`` says, if that is less.
LEAST_PARTITIONS = 200


def configure(spark) -> None:
    """Exact decimals (products keep the sum of their scales), UTC, ANSI errors and shuffles sized by bytes for this session."""
    for k, v in SESSION.items():
        spark.conf.set(k, v)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(max(LEAST_PARTITIONS, int(spark.conf.get("spark.sql.shuffle.partitions")))))


def partition_date(ts: Column) -> Column:
    """The UTC day of a block's whole-second time."""
    return F.to_date(F.date_trunc("second", ts))


def checked_long(value: Column) -> Column:
    """An unsigned 64-bit value (as decimal(20,0)) as long; above 2^63 - 1 the query fails rather than wrap."""
    fits = value.isNull() | value.between(0, (1 << 63) - 1)
    return F.when(fits, value.cast("long")).otherwise(F.raise_error(F.lit("unsigned value does not fit a long")).cast("long"))


def is_long(value: Column) -> Column:
    return value.isNull() | value.between(0, (1 << 63) - 1)


def identifier_hex(df: DataFrame, columns: list[str], prefix: bool = True) -> DataFrame:
    """Binary identifiers as lowercase hex, with or without 0x; text identifiers stay as they are."""
    def form(c: str) -> Column:
        h = F.lower(F.hex(F.col(c)))
        return F.concat(F.lit("0x"), h) if prefix else h

    binary = {f.name for f in df.schema if isinstance(f.dataType, T.BinaryType)}
    return df.withColumns({c: form(c) for c in columns if c in binary})


def enum_label(value: Column, labels: dict[int, str], prefix: str) -> Column:
    """The label of an enum number without its type prefix; UNKNOWN for numbers outside the list."""
    table = F.create_map(*[F.lit(x) for k, v in labels.items() for x in (k, v.removeprefix(prefix))])
    return F.when(value.isNotNull(), F.coalesce(F.try_element_at(table, value), F.lit("UNKNOWN")))


def preferred_address(modern: Column, legacy: Column) -> Column:
    """The modern address, else the first of the legacy list, else null; empty text counts as absent."""
    return F.coalesce(F.nullif(modern, F.lit("")), F.nullif(F.get(legacy, 0), F.lit("")))
