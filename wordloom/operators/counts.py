"""Trigram counts per corpus part, and the size of the corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.operators.parse import split_words


def count_trigrams(parts: DataFrame) -> DataFrame:
    """``w1, w2, w3, r1, r2`` from ``trigram, part, occurrences``.

    One shuffle. Spark sums inside each map task first, so a trigram that makes up a third
    of the corpus arrives as one row per task. Grouping by the trigram as one string keeps
    the shuffled rows short; it is cut into words afterwards, once per distinct trigram.
    """
    def in_part(part: int):
        return F.sum(F.when(F.col("part") == part, F.col("occurrences")).otherwise(0))

    counts = parts.groupBy("trigram").agg(in_part(1).alias("r1"), in_part(2).alias("r2"))
    return split_words(counts)


def corpus_total(occurrences: DataFrame) -> DataFrame:
    """One row ``n``: all occurrences of all trigrams, 0 for an empty corpus.

    Summed over the occurrence rows, so nothing has to be grouped by trigram for it.
    """
    return occurrences.agg(F.coalesce(F.sum("occurrences"), F.lit(0)).alias("n"))
