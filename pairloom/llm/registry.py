"""The corpus operators' queries and oracle SQL."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

#: Module of this subpackage -> the query it registers.
MODULES = {
    "simhash": "op2_simhash_near_dedup",
    "bpe": "op3_byte_bpe",
    "tokenbin": "op9_token_binary",
    "isomedia": "op10_iso_media",
    "quality": "op1_host_quality",
    "mixture": "op4_source_mixture",
    "lm": "op6_lm_score",
    "pii": "op8_pii_surrogates",
    "langid": "op7_language_id",
    "tokencount": "op5_token_counts",
    "fim": "op11_fill_in_middle",
    "whiten": "op12_embedding_whitening",
    "packing": "op13_best_fit_packing",
}

#: Further queries: name -> (module, function).
MORE = {"op7_page_language_id": ("langid", "page_query"), "op4_overlapping_mixture": ("mixture", "overlap_query")}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {name: importlib.import_module(f"{__package__}.{module}").query for module, name in MODULES.items()}
    return found | {name: getattr(importlib.import_module(f"{__package__}.{module}"), function) for name, (module, function) in MORE.items()}


def oracle_sql() -> dict[str, str]:
    found = {name: getattr(importlib.import_module(f"{__package__}.{module}"), "ORACLE_SQL", None) for module, name in MODULES.items()}
    return {name: sql for name, sql in found.items() if sql is not None}
