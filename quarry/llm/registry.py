"""Names of the training-data queries and of their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quarry.llm import binary_packing, chat_format, divergence, language_id, lexical_search, license_scan, mixing, near_dedup, neighbours, packing, quality_rules, token_counts, warc

MODULES = {
    "op1_packing": packing,
    "op2_license_scan": license_scan,
    "op3_chat_format": chat_format,
    "op4_near_dedup": near_dedup,
    "op5_neighbours": neighbours,
    "op6_token_counts": token_counts,
    "op7_language_id": language_id,
    "op8_quality_rules": quality_rules,
    "op9_warc": warc,
    "op10_mixing": mixing,
    "op11_source_divergence": divergence,
    "op12_lexical_search": lexical_search,
    "op13_binary_packing": binary_packing,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: m.query for name, m in MODULES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: m.ORACLE_SQL for name, m in MODULES.items() if getattr(m, "ORACLE_SQL", None)}
