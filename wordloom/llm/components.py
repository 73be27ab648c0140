"""Connected components by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.llm.common import stage


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (two columns ``a, b`` of type long).

    In each round every node joins the neighbour (or itself) of least priority, priorities
    being a hash that changes per round, and the edges are rewritten between what the nodes
    joined. Random priorities shrink long chains as fast as stars, so the edges fall
    geometrically; rounds are staged, and only their number of rows comes to the driver.
    ``root`` is some node of the component, the same for all of them.
    """
    both = edges.where("a <> b").select("a", "b")
    both = stage(both.union(both.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    roots = None
    round_no = 0
    while not both.isEmpty():
        def ranked(c, salt=round_no):
            return F.struct(F.xxhash64(F.col(c), F.lit(salt)).alias("p"), F.col(c).alias("n"))

        joined = stage(
            both.groupBy("a")
            .agg(F.min(ranked("b")).alias("least"))
            .select("a", F.least("least", ranked("a"))["n"].alias("r")),
            "joined",
        )
        to = joined.select(F.col("a").alias("b"), F.col("r").alias("s"))
        both = stage(
            both.join(joined, "a").join(to, "b").where("r <> s")
            .select(F.col("r").alias("a"), F.col("s").alias("b")).distinct(),
            "edges",
        )
        if roots is None:
            roots = joined.select(F.col("a").alias("node"), F.col("r").alias("root"))
        else:
            step = joined.select(F.col("a").alias("root"), "r")
            roots = stage(
                roots.join(step, "root", "left").select("node", F.coalesce("r", "root").alias("root")),
                "roots",
            )
        round_no += 1
    if roots is None:
        return both.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots
