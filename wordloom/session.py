"""Local session for tests and the benchmark; the library itself never creates one."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def local_session(cores: str | int = "*", **settings: str) -> SparkSession:
    """One machine is the whole cluster here, so a folder of its own can be the shared one."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("wordloom")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for name, value in settings.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    if spark.conf.get("spark.checkpoint.dir", None) is None:
        spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="wordloom-"))
    spark.sparkContext.setLogLevel("ERROR")
    return spark
