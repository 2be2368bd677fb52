"""Tables written once to the folder every executor shares, to cut lineage and survive lost executors."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: Spark deletes a query's shuffle files as soon as the query has ended, not when the driver's JVM happens to collect it.
_AT_ONCE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def ship(spark: SparkSession) -> None:
    """Send this package's sources to the executors' Python workers, once a context; where they have it installed this changes nothing."""
    context, top = spark.sparkContext, Path(__file__).resolve().parents[1]
    if getattr(context, "_blockwright_shipped", False):
        return
    path = Path(tempfile.mkdtemp(prefix="spark-package-")) / f"{top.name}.zip"
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(top.rglob("*.py")):
            z.write(f, f.relative_to(top.parent))
    context.addPyFile(str(path))
    context._blockwright_shipped = True


def shared_dir(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; a temporary folder only where that is unset and Spark runs on one machine (tests)."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="spark-shared-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: later steps never recompute or lose it, and its shuffle files are gone."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(_AT_ONCE, "false")
    spark.conf.set(_AT_ONCE, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_AT_ONCE, before)
    back = spark.read.schema(df.schema).parquet(path)
    back.written_to = path
    return back


def sweep(spark: SparkSession) -> None:
    """Let Spark's cleaner delete the shuffle files of finished steps now: it does so only for objects that the driver's JVM has collected."""
    spark.sparkContext._jvm.System.gc()


def forget(*tables: DataFrame) -> None:
    """Delete the files of tables from ``written`` that no result still to be computed reads."""
    for df in tables:
        context = df.sparkSession.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(df.written_to)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def with_text(docs: DataFrame, *more: str) -> DataFrame:
    """Only the columns an operator reads, so that extra columns of any name can't clash."""
    return docs.select(*[docs[c] for c in ("doc_id", "text", *more)])
