"""The operators as stages of the corpus pipeline.

A stage takes (spark, docs, sf_dir). All but the last return the columns of ``documents``, and
extra ones as they came. Documents are taken out by id, so one with a null id, which cannot be
named, stays; rows of the same id stay or go together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.llm.common import stage, table
from wordloom.llm.decontamination import contaminated
from wordloom.llm.packing import pack_documents
from wordloom.llm.simhash import near_duplicates
from wordloom.llm.suffix_dedup import remove_repeats
from wordloom.llm.toxicity import train, without_toxic

# The contract of SimHash near-duplicates: words in a shingle, bits that may differ.
NEAR_WORDS, NEAR_BITS = 3, 2


def without(docs: DataFrame, ids: DataFrame, name: str) -> DataFrame:
    """``docs`` but for those whose id is among ``ids`` (one column)."""
    gone = ids.toDF("gone_id").where("gone_id is not null").distinct()
    gone = stage(gone, name)
    return docs.join(gone, docs["doc_id"] == gone["gone_id"], "left_anti")


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Toxic documents go."""
    return without_toxic(docs, train(docs, table(spark, sf_dir, "labels")))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by their fingerprints the one with the smallest id stays."""
    groups = near_duplicates(docs, NEAR_WORDS, NEAR_BITS)
    return without(docs, groups.where("doc_id <> component_id").select("doc_id"), "near_copies")


def repeated_passage_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts lose the passages that a document of smaller id holds too.

    What is left of a character whose bytes were not all removed goes as well; a null text
    becomes an empty one; ``n_chars`` is counted anew.
    """
    found = remove_repeats(docs, decode=True)
    columns = []
    for i, name in enumerate(docs.columns):
        column = F.col("kept") if name == "text" else F.col(f"c{i}")
        if name == "n_chars":
            column = F.length("kept").cast(docs.schema[name].dataType)
        columns.append(column.alias(name))
    return found.select(*columns)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    leaks = contaminated(docs, table(spark, sf_dir, "benchmark"))
    return without(docs, leaks.select("doc_id"), "contaminated")


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of what is left, with their places in the training sequences."""
    import public_tokenizers

    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))
