"""Statistics attached to every trigram: the equi-join on (r1, part 1) and (r2, part 2)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STATS = ["nr1", "tr1", "nr2", "tr2"]


def _part(stats: DataFrame, part: int) -> DataFrame:
    nr, tr = f"nr{part}", f"tr{part}"
    return stats.select(F.col("r").alias(f"r{part}"), nr, tr)


def _zero_filled(joined: DataFrame) -> DataFrame:
    kept = [c for c in joined.columns if c not in STATS]
    return joined.select(*kept, *[F.coalesce(c, F.lit(0)).alias(c) for c in STATS])


def lookup_broadcast(counts: DataFrame, stats: DataFrame) -> DataFrame:
    """Two broadcast joins; the trigrams stay where they are.

    For statistics of a checked size only, see :func:`lookup_shuffled`.
    """
    joined = counts.join(F.broadcast(_part(stats, 1)), "r1", "left").join(
        F.broadcast(_part(stats, 2)), "r2", "left"
    )
    return _zero_filled(joined).select("w1", "w2", "w3", "r1", "r2", *STATS)


def lookup_shuffled(
    counts: DataFrame, cells: DataFrame, stats: DataFrame, trigrams: int, head_rows: int
) -> DataFrame:
    """The same join when the statistics are too many to broadcast.

    Statistics are joined to the (r1, r2) cells first, then cells to trigrams. A cell's
    ``trigrams`` is exactly the number of rows its join key has, so cells with more than
    ``trigrams / head_rows`` rows are the hot keys; there are fewer than ``head_rows`` of
    them, and these are broadcast. The remaining keys are shuffled, none of them holding
    more than a ``1 / head_rows`` share of the table.
    """
    key = ["r1", "r2"]
    share = trigrams // head_rows
    cell_stats = _zero_filled(
        cells.join(_part(stats, 1), "r1", "left").join(_part(stats, 2), "r2", "left")
    )
    is_hot = F.col("trigrams") > share
    head = cell_stats.where(is_hot).drop("trigrams")
    tail = cell_stats.where(~is_hot).drop("trigrams")
    head_keys = cells.where(is_hot).select(*key)
    hot = counts.join(F.broadcast(head), key)
    rest = counts.join(F.broadcast(head_keys), key, "left_anti").join(tail, key, "left")
    return _zero_filled(hot.unionByName(rest)).select("w1", "w2", "w3", "r1", "r2", *STATS)


def stats_rows(wide: DataFrame) -> DataFrame:
    """``w1, w2, w3, part, nr, tr``: one row per trigram and part."""
    return wide.select(
        "w1",
        "w2",
        "w3",
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(part).alias("part"),
                        F.col(f"nr{part}").alias("nr"),
                        F.col(f"tr{part}").alias("tr"),
                    )
                    for part in (1, 2)
                ]
            )
        ),
    )
