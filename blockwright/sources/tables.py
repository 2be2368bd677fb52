"""Reading nested blocks, writing tables by day, and reading them back consistently."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LAST_TABLE = "blocks"


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the cluster's ``spark.checkpoint.dir``; a temporary folder only where that is unset and Spark runs on one machine (tests)."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="spark-shared-")
        spark.conf.set("spark.checkpoint.dir", found)
    return f"{found.rstrip('/')}/{name}-{uuid.uuid4().hex}"


_SCOPES: list[list[str]] = []


def stored_table(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once and read back: lineage ends there, and the sizes Spark plans with are real. Inside ``temporary_tables`` it goes when that ends."""
    path = shared_path(df.sparkSession, name)
    if _SCOPES:
        _SCOPES[-1].append(path)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def temporary_tables(spark: SparkSession) -> Iterator[None]:
    """Deletes the stored tables made inside, once what is computed from them has been written."""
    _SCOPES.append([])
    try:
        yield
    finally:
        for path in _SCOPES.pop():
            remove(spark, path)


def _folder(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder of any file system Spark reads; none where it isn't there."""
    files, where = _folder(spark, path)
    return sorted(x.getPath().getName() for x in files.listStatus(where)) if files.exists(where) else []


def remove(spark: SparkSession, path: str) -> None:
    files, where = _folder(spark, path)
    files.delete(where, True)


def read_blocks(spark: SparkSession, path: str, schema: T.StructType | str, form: str = "parquet") -> DataFrame:
    """Nested block envelopes under a declared schema; columns go by name, nothing is inferred."""
    return spark.read.schema(schema).format(form).load(path)


def stream_blocks(spark: SparkSession, path: str, schema: T.StructType | str, form: str = "parquet", files_a_batch: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).format(form).option("maxFilesPerTrigger", files_a_batch).load(path)


def writer_options(lookup_columns: Iterable[str] = (), codec: str = "zstd", rows_a_group: int = 65_536) -> dict[str, str]:
    """Parquet options: codec, bounded row groups, Bloom filters on the columns that point lookups ask for."""
    out = {"compression": codec, "parquet.block.row.count.limit": str(rows_a_group)}
    for c in lookup_columns:
        out |= {f"parquet.bloom.filter.enabled#{c}": "true", f"parquet.bloom.filter.candidates.number#{c}": "8"}
    if len(out) > 2:
        # one of eight sizes from 1 to 128 KB, by the group's distinct values: 128 KB suit 65,536 of them
        out |= {"parquet.bloom.filter.adaptive.enabled": "true", "parquet.bloom.filter.max.bytes": str(1 << 17)}
    return out


def write_tables(tables: dict[str, DataFrame], root: str, mode: str = "append", lookups: dict[str, list[str]] | None = None) -> None:
    """Every table by day; ``blocks`` last, so that what it holds is complete in all others.

    Rows of a day are gathered by range of block within the day before they are written: few files, in block order. The number of ranges is
    Spark's number of shuffle partitions, stated, as adaptive execution would join small ranges to one task that opens all days' files in turn.
    """
    for name in sorted(tables, key=lambda n: (n == LAST_TABLE, n)):
        df = tables[name]
        options = writer_options((lookups or {}).get(name, ()))
        ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        rows = df.repartitionByRange(ranges, "date", "block_num").sortWithinPartitions("date", "block_num") if "block_num" in df.columns else df
        rows.write.mode(mode).options(**options).partitionBy("date").parquet(f"{root}/{name}")


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}")


def register_views(spark: SparkSession, root: str, names: Iterable[str], prefix: str = "") -> None:
    for n in names:
        table(spark, root, n).createOrReplaceTempView(prefix + n)


def frontier(blocks: DataFrame, column: str = "block_num") -> int | None:
    """The newest block (or ordinal, for an event history) that all tables hold."""
    return blocks.agg(F.max(column)).first()[0]


def read_consistent(df: DataFrame, upto: int | None, column: str = "block_num") -> DataFrame:
    return df.where(F.col(column) <= F.lit(upto)) if upto is not None else df.limit(0)


def closed_dates(blocks: DataFrame) -> DataFrame:
    """Days below the newest one of ``blocks``; only those are done."""
    newest = blocks.agg(F.max("date").alias("_open"))
    return blocks.select("date").distinct().join(F.broadcast(newest), F.col("date") < F.col("_open")).select("date")


def day_block_range(blocks: DataFrame, date) -> DataFrame:
    return blocks.where(F.col("date") == F.lit(date)).agg(F.min("block_num").alias("first_block"), F.max("block_num").alias("last_block"))


def table_summary(df: DataFrame) -> DataFrame:
    """Rows, files and bytes of a stored table, from its file metadata and counts."""
    files = df.select(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_size").alias("b")).groupBy("f").agg(F.max("b").alias("b"), F.count("*").alias("n"))
    return files.agg(F.sum("n").alias("rows"), F.count("*").alias("files"), F.sum("b").alias("bytes"))


def write_metadata(spark: SparkSession, root: str, properties: dict[str, str]) -> None:
    """Provenance of a dataset beside its tables."""
    spark.createDataFrame(sorted(properties.items()), "key string, value string").coalesce(1).write.mode("overwrite").parquet(f"{root}/_dataset_meta")


def read_metadata(spark: SparkSession, root: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.read.parquet(f"{root}/_dataset_meta").collect()}


def with_provenance(df: DataFrame, properties: dict[str, str]) -> DataFrame:
    return df.withMetadata(df.columns[0], dict(properties))
