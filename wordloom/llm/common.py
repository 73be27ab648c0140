"""Small helpers of this folder: columns by position, staging, the folds of the labels."""

from __future__ import annotations

import gc
import os
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.plans.staging import stage

__all__ = ["documents", "fold", "give_back", "partitions", "prepare", "stage", "table", "text_bytes"]


def documents(docs: DataFrame, *columns: str) -> DataFrame:
    """Only the named columns, so that extra ones can neither clash nor be carried along."""
    return docs.select(*columns)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_bytes(column: str = "text") -> Column:
    """The UTF-8 bytes of a text; a null text has none."""
    return F.coalesce(F.col(column), F.lit("")).cast("binary")


def fold(folds: int, doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo ``folds``."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % F.lit(folds)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def give_back() -> None:
    """Return freed memory to the system at the end of a task.

    Python workers outlive their tasks, and those of other operators run beside them.
    """
    gc.collect()
    pa.default_memory_pool().release_unused()


def prepare(spark: SparkSession) -> None:
    """What every operator asks of its session; harmless to repeat.

    Spark is to delete a query's shuffle files when the query ends: operators of several steps
    write each step to the shared folder, so no later step reads an earlier one's files, and
    without this they stay until the driver's JVM happens to collect its garbage. Rows go to
    Python in batches small enough for long texts. Python
    workers look for this package where the driver found it (on a cluster without that path,
    ``--py-files`` brings it).
    """
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    root = str(Path(__file__).resolve().parents[2])
    if root not in paths:
        paths = [root, *filter(None, paths)]
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(paths)
