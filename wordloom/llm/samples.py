"""Bounded samples of labelled documents to learn from."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.llm.common import fold, stage, text_bytes


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, per_class: int, folds: int = 3, left_out: int = 1
) -> DataFrame:
    """``doc_id, label, data`` of at most ``per_class`` documents with label 0 and as many with 1.

    Ids are drawn in the order of their hash, outside the fold that is left out; only ids are
    drawn, so the bound holds for what is broadcast too. An id with several labels has the
    greatest. Equal texts are taken once, lest a group of copies teach its own words.
    """
    known = labels.select("doc_id", F.col(label).cast("int").alias("label"))
    known = known.where(F.col("label").isin(0, 1) & (fold(folds) != left_out))
    known = known.groupBy("doc_id").agg(F.max("label").alias("label"))
    drawn = None
    for value in (0, 1):
        own = known.where(F.col("label") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        drawn = own if drawn is None else drawn.unionByName(own)
    drawn = stage(drawn, f"drawn_{label}")
    texts = docs.select("doc_id", text_bytes().alias("data")).join(F.broadcast(drawn), "doc_id")
    first = texts.groupBy("label", "data").agg(F.min("doc_id").alias("doc_id"))
    return stage(first.select("doc_id", "label", "data"), f"sample_{label}")
