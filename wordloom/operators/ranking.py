"""Order of the next-word table: by word pair, then by falling probability.

Ties on the probability are broken by the third word, which makes the order total.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

PAIR = ["w1", "w2"]


def sort_table(table: DataFrame) -> DataFrame:
    """Global sort. The sort key is unique per row, so range partitions stay even however
    many rows one pair has."""
    return table.orderBy("w1", "w2", F.desc("p"), "w3")


def next_words(table: DataFrame, k: int) -> DataFrame:
    """The ``k`` most probable third words of every pair, with their position.

    For ``row_number() <= k`` Spark keeps the best k per pair inside every map task before
    the shuffle, so a pair with very many followers sends at most k rows per task.
    """
    pos = F.row_number().over(Window.partitionBy(*PAIR).orderBy(F.desc("p"), "w3"))
    return table.withColumn("pos", pos).where(F.col("pos") <= k).select(
        "w1", "w2", "w3", "p", F.col("pos").cast("bigint").alias("pos")
    )


def number_rows(table: DataFrame, lead: tuple[str, ...] = ()) -> DataFrame:
    """``table`` in global order with ``pos``, the position within its pair.

    A single shuffle: range partitions on the pair satisfy both the window and the order.
    All rows of a pair meet in one task; see :func:`number_rows_sliced` for large pairs.
    ``lead`` names columns that depend on the pair only and come first in the order; they are kept.
    """
    group = [*lead, *PAIR]
    return _number(table.repartitionByRange(*group), group, lead)


def _number(ranged: DataFrame, group: list[str], kept: tuple[str, ...]) -> DataFrame:
    window = Window.partitionBy(*group).orderBy(F.desc("p"), "w3")
    return ranged.withColumn("pos", F.row_number().over(window).cast("bigint")).select(
        "w1", "w2", "w3", "p", *kept, "pos"
    )


def _rank_key() -> Column:
    """Struct that sorts as the rows of a pair do."""
    return F.struct((-F.col("p")).alias("neg_p"), F.col("w3").alias("w3"))


def slice_cuts(table: DataFrame, slice_rows: int, points: int) -> DataFrame:
    """``w1, w2, cuts``: where to cut the pairs that are too large for one task.

    ``cuts`` is a sorted array of row keys about ``slice_rows`` rows apart; pairs without
    at least two such cuts are left out. Cuts only decide which task numbers which rows,
    so they may rest on a share of the rows: those whose hash falls on a grid of
    ``slice_rows / points``, ``points`` of them per slice. The hash depends on content alone, so a
    re-run task finds the same cuts.
    """
    grid = max(1, slice_rows // points)
    per_slice = slice_rows // grid
    on_grid = F.pmod(F.xxhash64("w1", "w2", "w3"), F.lit(grid)) == 0
    order = Window.partitionBy(*PAIR).orderBy("key")
    return (
        table.where(on_grid)
        .select(*PAIR, _rank_key().alias("key"))
        .withColumn("i", F.row_number().over(order))
        .where(F.col("i") % per_slice == 0)
        .groupBy(*PAIR)
        .agg(F.array_sort(F.collect_list("key")).alias("cuts"))
        .where(F.size("cuts") >= 2)
    )


def _with_slice(table: DataFrame, cuts: DataFrame, longest: int) -> DataFrame:
    """``table`` with ``slice``, the number of cuts of its pair not after the row.

    A binary search in the sorted array, one column step per halving. All of it is
    generated code on the joined row, so the array is never copied; a pair without cuts
    stays in slice 0.
    """
    found = table.join(F.broadcast(cuts), PAIR, "left").select(
        "*", _rank_key().alias("key"), F.lit(0).alias("slice")
    )
    for bit in reversed(range(longest.bit_length())):
        probe = F.col("slice") + (1 << bit)
        hit = (probe <= F.size("cuts")) & (F.get("cuts", probe - 1) <= F.col("key"))
        found = found.withColumn("slice", F.when(hit, probe).otherwise(F.col("slice")))
    return found.drop("key")


def number_rows_sliced(
    table: DataFrame, cuts: DataFrame, longest: int, lead: tuple[str, ...] = ()
) -> DataFrame:
    """As :func:`number_rows`, but the pairs in ``cuts`` are numbered slice by slice.

    Slices follow the order of the rows, so a row's position is its place in its slice
    plus the rows of the slices before. ``cuts`` holds about one entry per ``slice_rows``
    rows of the table, at most ``longest`` for one pair; it is broadcast, as are the
    slice totals.
    """
    sliced = _with_slice(table, cuts, longest)
    group = [*PAIR, "slice"]
    before = Window.partitionBy(*PAIR).orderBy("slice").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = (
        sliced.where(F.col("cuts").isNotNull())
        .groupBy(*group)
        .agg(F.count("*").alias("rows"))
        .select(*group, F.sum("rows").over(before).alias("rows_before"))
    )
    ordered = [*lead, *group]
    numbered = _number(sliced.drop("cuts").repartitionByRange(*ordered), ordered, (*lead, "slice"))
    return numbered.join(F.broadcast(offsets), group, "left").select(
        "w1", "w2", "w3", "p", *lead, (F.col("pos") + F.coalesce("rows_before", F.lit(0))).alias("pos")
    )
