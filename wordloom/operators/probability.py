"""Deleted-estimation probability of every trigram."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.functions.ngrams import deleted_estimation

WORDS = ["w1", "w2", "w3"]


def probability(wide: DataFrame, total: DataFrame) -> DataFrame:
    """``w1, w2, w3, p`` from one row per trigram; ``total`` is the one-row table ``n``.

    N enters as a scalar subquery: Spark runs it once and hands the number to all tasks.
    """
    stats = [F.col(c) for c in ("tr1", "tr2", "nr1", "nr2")]
    return wide.select(*WORDS, deleted_estimation(*stats, total.scalar()).alias("p"))


def probability_from_rows(rows: DataFrame, total: DataFrame) -> DataFrame:
    """``w1, w2, w3, p`` from one row per trigram and part, whose order does not matter."""
    def of(part: int, value: str):
        return F.sum(F.when(F.col("part") == part, F.col(value)).otherwise(0))

    merged = rows.groupBy(*WORDS).agg(
        of(1, "nr").alias("nr1"),
        of(1, "tr").alias("tr1"),
        of(2, "nr").alias("nr2"),
        of(2, "tr").alias("tr2"),
    )
    return probability(merged, total)
