"""The registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from locusmill.llm import sql
from locusmill.llm.common import table
from locusmill.llm.curve_packing import op5_curve_packing
from locusmill.llm.hash_tree import op9_hash_tree
from locusmill.llm.jaccard import op6_combination_prefixes
from locusmill.llm.katz import op4_katz_backoff
from locusmill.llm.main_text import op11_host_paths
from locusmill.llm.merkle import op12_merkle_manifest
from locusmill.llm.mixing import op1_source_mix
from locusmill.llm.quality import op3_llr_rules
from locusmill.llm.secret_index import op10_trigram_index
from locusmill.llm.token_counts import op7_whole_tokens
from locusmill.llm.url_graph import op2_trust_spread
from locusmill.llm.vector_codes import op13_limb_codes
from locusmill.llm.winnow import op8_winnowing


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    docs = lambda f: lambda spark, d: f(table(spark, d, "documents"))
    return {
        "op1_source_mix": docs(op1_source_mix),
        "op2_trust_spread": lambda spark, d: op2_trust_spread(table(spark, d, "pages")),
        "op3_llr_rules": op3_llr_rules,
        "op4_katz_backoff": docs(op4_katz_backoff),
        "op5_curve_packing": docs(op5_curve_packing),
        "op6_combination_prefixes": docs(op6_combination_prefixes),
        "op7_whole_tokens": docs(op7_whole_tokens),
        "op8_winnowing": docs(op8_winnowing),
        "op9_hash_tree": docs(op9_hash_tree),
        "op10_trigram_index": docs(op10_trigram_index),
        "op11_host_paths": lambda spark, d: op11_host_paths(table(spark, d, "pages")),
        "op12_merkle_manifest": docs(op12_merkle_manifest),
        "op13_limb_codes": lambda spark, d: op13_limb_codes(table(spark, d, "embeddings")),
    }


def oracle_sql() -> dict[str, str]:
    return {"op12_merkle_manifest": sql.manifest(), "op13_limb_codes": sql.codes()}
