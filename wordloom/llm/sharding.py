"""Consistent-hash ring with virtual nodes and bounded loads, in DataFrame operations.

Every shard owns ``vnodes`` points of a ring. A row belongs to the first point clockwise of
its key's hash; if that point's shard is full, the row continues clockwise to the next point
whose shard has room. With ``slack`` 0 the capacities add up to the number of rows, so that
the shards' counts are at most one apart (law ``rows``); with a positive slack each holds at
most ``(1 + slack)`` times the mean, and fewer rows move when a shard is added.

Which rows fit is decided from counts. The ring is cut into ``2**RING_BITS`` cells; rows are
counted per cell, which gives a table of fixed size, and the overflow is worked out on arcs
(all rows between two points) in rounds: in round d, what is left of each arc asks the d-th
point clockwise. The outcome is a short list of intervals "rows lo..hi of this arc go to that
shard from this slot on". A row needs only its rank within its arc to find its interval: its
cell's offset plus its position within the cell, so no task orders more than one cell.

Defined results: a null text has no bytes (size 16); a null ``doc_id`` is a key like any
other; repeated rows are counted together, placed as a run, and told apart by their slots; an
empty table gives no rows; columns other than ``doc_id`` and ``text`` are not used.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wordloom.llm.common import documents, prepare, stage, text_bytes

RING_BITS = 16
CELLS = 1 << RING_BITS


def ring_points(shards: int, vnodes: int) -> list[tuple[int, int]]:
    """(cell, shard) of all points, clockwise. A point lies at the end of its cell; a shard's
    points do not depend on how many shards there are."""
    points = []
    for shard in range(shards):
        for v in range(vnodes):
            digest = hashlib.blake2b(f"{shard}/{v}".encode(), digest_size=8).digest()
            points.append((int.from_bytes(digest, "big") % CELLS, digest, shard))
    return [(cell, shard) for cell, _, shard in sorted(points)]


def capacities(rows: int, shards: int, slack: float) -> list[int]:
    if slack > 0:
        return [-(-int((1 + slack) * rows) // shards) + 1] * shards
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def place_arcs(
    arc_rows: list[int], owners: list[int], room: list[int]
) -> list[tuple[int, int, int, int, int]]:
    """Intervals (arc, lo, hi, shard, slot) by sending each arc's overflow clockwise."""
    room, size = list(room), len(owners)
    used = [0] * len(room)
    left = [(arc, 0) for arc in range(size) if arc_rows[arc]]
    intervals = []
    for step in range(size):
        if not left:
            break
        overflow = []
        for arc, lo in left:
            shard = owners[(arc + step) % size]
            take = min(room[shard], arc_rows[arc] - lo)
            if take:
                intervals.append((arc, lo, lo + take, shard, used[shard]))
                room[shard] -= take
                used[shard] += take
            if lo + take < arc_rows[arc]:
                overflow.append((arc, lo + take))
        left = overflow
    return intervals


def shard_documents(
    docs: DataFrame, shards: int = 40, vnodes: int = 64, slack: float = 0.0
) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot``; see the module's docstring."""
    if shards < 1 or vnodes < 1 or shards * vnodes > CELLS:
        raise ValueError(f"between 1 and {CELLS} points are possible")
    spark = docs.sparkSession
    prepare(spark)
    data = text_bytes()
    keyed = documents(docs, "doc_id", "text").select(
        "doc_id",
        (F.octet_length(data).cast("long") + 16).alias("size"),
        F.crc32(data).alias("text_crc32"),
    )
    groups = keyed.groupBy("doc_id", "size", "text_crc32").agg(F.count("*").alias("copies"))
    position = F.xxhash64("doc_id")
    cell = F.shiftrightunsigned(position, 64 - RING_BITS).cast("int")
    groups = stage(groups.withColumns({"cell": cell, "position": position}), "ring_rows")

    counts = {r["cell"]: r["n"] for r in groups.groupBy("cell").agg(F.sum("copies").alias("n")).collect()}
    points = ring_points(shards, vnodes)
    owners = [shard for _, shard in points]
    arc_rows, offsets, arc = [0] * len(points), [], 0
    for cell_id in range(CELLS):
        while arc < len(points) and points[arc][0] < cell_id:
            arc += 1
        own = arc % len(points)  # past the last point: on to the first
        offsets.append((cell_id, own, arc_rows[own]))
        arc_rows[own] += counts.get(cell_id, 0)
    intervals = place_arcs(arc_rows, owners, capacities(sum(arc_rows), shards, slack))

    # Both tables are bounded by the parameters: CELLS rows, and about a row per point.
    cells = spark.createDataFrame(offsets, "cell int, arc int, cell_offset long")
    ranges = spark.createDataFrame(
        intervals or [], "arc int, lo long, hi long, shard int, first_slot long"
    )
    order = Window.partitionBy("cell").orderBy("position", "doc_id", "size", "text_crc32")
    before = F.sum("copies").over(order.rowsBetween(Window.unboundedPreceding, -1))
    ranked = (
        groups.withColumn("before", F.coalesce(before, F.lit(0)))
        .join(F.broadcast(cells), "cell")
        .withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
        .withColumn("rank", F.col("cell_offset") + F.col("before") + F.col("copy"))
    )
    inside = (F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi"))
    placed = ranked.alias("r").join(
        F.broadcast(ranges.alias("i")), (F.col("r.arc") == F.col("i.arc")) & inside
    )
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        "shard",
        (F.col("first_slot") + F.col("rank") - F.col("lo")).alias("slot"),
    )


def op9_ring_shards(spark, sf_dir) -> DataFrame:
    """All documents in 40 shards; counts at most one apart."""
    placed = shard_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), shards=40)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
