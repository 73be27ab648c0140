"""Intermediate tables in shared storage, and size checks."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MAX_BROADCAST_ROWS = 1_000_000


def shared_folder(spark: SparkSession) -> str:
    """The folder the session names in ``spark.checkpoint.dir``."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return folder.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """An unused path below one folder per application, which can go when that has ended."""
    application = f"{shared_folder(spark)}/{spark.sparkContext.applicationId}"
    return f"{application}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str, by: str | None = None, below: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and return a scan of it.

    Used where a table feeds several later steps: it is computed once, a lost executor
    does not take it along, and the readers get column pruning and row counts for free.
    With ``by``, rows are stored by that column, and reading some of its values reads no more.
    ``below`` names a folder of :func:`new_path` to hold several tables that go together.
    """
    spark = df.sparkSession
    path = f"{below}/{name}" if below else new_path(spark, name)
    writer = df.write.partitionBy(by) if by else df.write
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free(spark: SparkSession, path: str) -> None:
    """Delete a folder of :func:`new_path`; nothing may read its tables afterwards."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def drop_shuffles(spark: SparkSession) -> None:
    """Have Spark delete a query's shuffle files when the query ends.

    For plans that write a table and read it again: otherwise the files of the writing stay beside
    those of the reading until the driver's JVM happens to collect its garbage.
    """
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def broadcast_if_small(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``max_rows`` rows."""
    staged = stage(df, "lookup")
    return F.broadcast(staged) if staged.count() <= max_rows else staged
