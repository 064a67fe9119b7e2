"""The queries of this subpackage by name, and the DuckDB statements of those SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from haulgrid.llm import (
    decontaminate, language, licenses, merkle, mixing, packing, preferences, quality, spelling, substrings, topk, toxicity,
)
from haulgrid.llm.simhash import op3_simhash

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_top_k": topk.op1_top_k,
    "op2_quality": quality.op2_quality,
    "op3_simhash": op3_simhash,
    "op4_language": language.op4_language,
    "op5_licenses": licenses.op5_licenses,
    "op6_substring_dedup": substrings.op6_substring_dedup,
    "op7_decontamination": decontaminate.op7_decontamination,
    "op8_toxicity": toxicity.op8_toxicity,
    "op9_mixing": mixing.op9_mixing,
    "op10_preferences": preferences.op10_preferences,
    "op11_packing": packing.op11_packing,
    "op12_merkle": merkle.op12_merkle,
    "op13_spelling": spelling.op13_spelling,
}

STATEMENTS: dict[str, str] = {
    "op1_top_k": topk.SQL,
    "op6_substring_dedup": substrings.SQL,
    "op7_decontamination": decontaminate.SQL,
    "op10_preferences": preferences.SQL,
    "op12_merkle": merkle.SQL,
    "op13_spelling": spelling.SQL,
}
