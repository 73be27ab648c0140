"""Count-of-count and held-out statistics per frequency."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unpivot_counts(counts: DataFrame) -> DataFrame:
    """``r, part, other``: each trigram's frequency in a part and in the other part."""
    def side(own: str, part: int, other: str):
        return F.struct(
            F.col(own).alias("r"), F.lit(part).alias("part"), F.col(other).alias("other")
        )

    return counts.select(F.inline(F.array(side("r1", 1, "r2"), side("r2", 2, "r1"))))


def frequency_cells(counts: DataFrame) -> DataFrame:
    """``r1, r2, trigrams``: number of trigrams per pair of frequencies.

    All statistics and the probability depend on this pair only. Most trigrams are seen
    once, so the map-side sum leaves next to nothing of the large table to shuffle, and
    the heavy frequencies 0 and 1 never gather in one task.
    """
    return counts.groupBy("r1", "r2").agg(F.count("*").alias("trigrams"))


def frequency_stats(cells: DataFrame) -> DataFrame:
    """``r, part, nr, tr`` for the parts in which a frequency occurs.

    ``nr`` counts the trigrams seen exactly r times in the part (r = 0: seen in the other
    part only), ``tr`` is the total count of those trigrams in the other part.
    """
    return _sides(cells).groupBy("r", "part").agg(F.sum("nr").alias("nr"), F.sum("tr").alias("tr"))


def frequency_stats_wide(cells: DataFrame) -> DataFrame:
    """``r, nr1, tr1, nr2, tr2``: both parts for every frequency, 0 where it is not seen."""
    def of(part: int, value: str):
        return F.sum(F.when(F.col("part") == part, F.col(value)).otherwise(0))

    return _sides(cells).groupBy("r").agg(
        of(1, "nr").alias("nr1"),
        of(1, "tr").alias("tr1"),
        of(2, "nr").alias("nr2"),
        of(2, "tr").alias("tr2"),
    )


def _sides(cells: DataFrame) -> DataFrame:
    def side(own: str, part: int, other: str):
        return F.struct(
            F.col(own).alias("r"),
            F.lit(part).alias("part"),
            F.col("trigrams").alias("nr"),
            (F.col("trigrams") * F.col(other)).alias("tr"),
        )

    return cells.select(F.inline(F.array(side("r1", 1, "r2"), side("r2", 2, "r1"))))


def total_from_stats(wide: DataFrame) -> DataFrame:
    """One row ``n`` from the small table: the two held-out masses add up to the corpus."""
    return wide.agg(F.coalesce(F.sum(F.col("tr1") + F.col("tr2")), F.lit(0)).alias("n"))


def step_union(counts: DataFrame, stats: DataFrame) -> DataFrame:
    """Bag union of two differently shaped tables; ``src`` tags the side."""
    return counts.select(F.lit("counts").alias("src"), "*").unionByName(
        stats.select(F.lit("nr_tr").alias("src"), "*"), allowMissingColumns=True
    )
