"""The corpus pipeline: from raw documents to packed sequences.

``STAGES`` are (name, function) pairs. Each function takes (spark, docs, sf_dir) and returns a
DataFrame, which is written as Parquet and read again as the next one's docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wordloom.llm.common import stage
from wordloom.llm.stages import (
    decontamination_stage,
    near_duplicate_stage,
    packing_stage,
    repeated_passage_stage,
    toxicity_stage,
)

STAGES = [
    ("toxicity", toxicity_stage),
    ("simhash_near_dedup", near_duplicate_stage),
    ("suffix_array_dedup", repeated_passage_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("packing", packing_stage),
]

# Fingerprints, models and token ids are beyond SQL; tests/llm has brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name)
    return docs
