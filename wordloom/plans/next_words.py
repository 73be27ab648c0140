"""Lookup of given word pairs in a next-word table laid out for it.

The table is written as Parquet, in folders by a hash of the pair (``bucket``), sorted by pair and
position within a folder, in small row groups with a Bloom filter on the pair. A lookup then reads
the folders that its pairs are in, of those the row groups that may hold a pair, and of these the
columns asked for:

- up to ``FEW`` pairs become literals: Spark prunes folders by them, Parquet row groups by their
  least and largest pair and by Bloom filter;
- more are joined, broadcast if there are at most ``max_broadcast_rows``; their buckets are a dynamic
  filter on the folders, worked out while the query runs. A list too long for that is shuffled, and
  reads the whole table, of which it asks a good part.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.plans.knowledge_base import KnowledgeBase
from wordloom.plans.staging import MAX_BROADCAST_ROWS, stage

# Parquet takes a list of up to so many values as single comparisons, which Bloom filters answer
# (spark.sql.parquet.pushdown.inFilterThreshold).
FEW = 10
BUCKETS, GROUP_BYTES = 64, 8 << 20
# The pair is stored once, as "W1 W2": words have no blanks.
TABLE = "w3 STRING, p DOUBLE, pos BIGINT, pair STRING, bucket INT"


def _pair() -> Column:
    return F.concat_ws(" ", "w1", "w2")


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64(_pair()), F.lit(buckets)).cast("int")


@dataclass
class NextWordTable:
    """A table of :func:`write_next_words` at ``path``, with the ``buckets`` it was written with."""

    spark: SparkSession
    path: str
    buckets: int = BUCKETS
    max_broadcast_rows: int = MAX_BROADCAST_ROWS
    few: int = FEW

    @property
    def rows(self) -> DataFrame:
        first, second = F.substring_index("pair", " ", 1), F.substring_index("pair", " ", -1)
        stored = self.spark.read.schema(TABLE).parquet(self.path)
        return stored.select(first.alias("w1"), second.alias("w2"), "w3", "p", "pos", "pair", "bucket")

    def lookup(self, pairs: DataFrame, k: int) -> DataFrame:
        """``w1, w2, w3, p, pos``: the ``k`` most probable third words of each of ``pairs(w1, w2)``.

        A pair asked for several times is answered once; one that the table does not have, or with
        a null, has no rows.
        """
        wanted = pairs.where("w1 is not null and w2 is not null").select("w1", "w2").distinct()
        wanted = wanted.where(~F.contains("w1", F.lit(" ")) & ~F.contains("w2", F.lit(" ")))  # no words
        wanted = stage(wanted.select(_pair().alias("pair"), _bucket(self.buckets).alias("bucket")), "wanted_pairs")
        best = self.rows.where(F.col("pos") <= k)
        few = wanted.limit(self.few + 1).collect()
        if len(few) <= self.few:
            found = best.where(F.col("bucket").isin([row["bucket"] for row in few])) if few else best.where("false")
            found = found.where(F.col("pair").isin([row["pair"] for row in few]))
        else:
            small = wanted.count() <= self.max_broadcast_rows
            wanted = wanted.where("bucket >= 0")  # true, but Spark makes a dynamic filter of filtered tables only
            found = best.join(F.broadcast(wanted) if small else wanted, ["bucket", "pair"], "left_semi")
        return found.select("w1", "w2", "w3", "p", "pos")


def write_next_words(
    ranked: DataFrame, path: str, buckets: int = BUCKETS, group_bytes: int = GROUP_BYTES
) -> NextWordTable:
    """Lay out ``ranked(w1, w2, w3, p, pos)`` at ``path`` for lookups.

    One shuffle by range of bucket, pair and position, a key that no two rows share, so a pair with
    very many followers is written by several tasks.
    """
    order = ["bucket", "pair", "pos"]
    rows = ranked.select("w3", "p", "pos", _pair().alias("pair"), _bucket(buckets).alias("bucket"))
    return _write(rows.repartitionByRange(*order).sortWithinPartitions(*order), path, buckets, group_bytes)


def write_knowledge_base(
    kb: KnowledgeBase, path: str, buckets: int = BUCKETS, group_bytes: int = GROUP_BYTES
) -> NextWordTable:
    """As :func:`write_next_words` of ``kb.ranked``, in one shuffle fewer: the rows are numbered in
    the order of the layout."""
    ranked = kb.ranked_by(bucket=_bucket(buckets))
    rows = ranked.select("w3", "p", "pos", _pair().alias("pair"), "bucket")
    return _write(rows, path, buckets, group_bytes)


def _write(placed: DataFrame, path: str, buckets: int, group_bytes: int) -> NextWordTable:
    options = {
        "parquet.bloom.filter.enabled#pair": "true",
        "parquet.bloom.filter.adaptive.enabled": "true",
        "parquet.block.size": str(group_bytes),
    }
    placed.write.partitionBy("bucket").options(**options).parquet(path)
    return NextWordTable(placed.sparkSession, path, buckets)
