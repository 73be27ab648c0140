"""The registered queries of this folder and their SQL.

No operator here can be written in DuckDB's SQL (it has no crc32 and no xxhash64, and most
of the operators learn, merge or sort in ways SQL lacks), so there is none; ``tests/llm`` holds
every query against a brute-force version, an exact round trip or held-out accuracy.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from wordloom.llm.decontamination import op2_latent_decontamination
from wordloom.llm.hash_forest import op4_hash_forest
from wordloom.llm.language_id import op6_recurrent_language
from wordloom.llm.license_scan import op12_license_scan
from wordloom.llm.line_quality import op1_line_quality
from wordloom.llm.packing import op7_best_fit_packing
from wordloom.llm.sharding import op9_ring_shards
from wordloom.llm.simhash import op3_simhash
from wordloom.llm.spelling_variants import op13_spelling_variants
from wordloom.llm.suffix_dedup import op10_suffix_dedup
from wordloom.llm.token_alignment import op11_token_alignment
from wordloom.llm.token_counts import op8_token_counts
from wordloom.llm.toxicity import op5_ordinal_toxicity


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_line_quality": op1_line_quality,
        "op2_latent_decontamination": op2_latent_decontamination,
        "op3_simhash": op3_simhash,
        "op4_hash_forest": op4_hash_forest,
        "op5_ordinal_toxicity": op5_ordinal_toxicity,
        "op6_recurrent_language": op6_recurrent_language,
        "op7_best_fit_packing": op7_best_fit_packing,
        "op8_token_counts": op8_token_counts,
        "op9_ring_shards": op9_ring_shards,
        "op10_suffix_dedup": op10_suffix_dedup,
        "op11_token_alignment": op11_token_alignment,
        "op12_license_scan": op12_license_scan,
        "op13_spelling_variants": op13_spelling_variants,
    }


def oracle_sql() -> dict[str, str]:
    return {}
