"""The queries of this subpackage and, where SQL can express one, its SQL."""

from __future__ import annotations

from importlib import import_module

# Query name and the module that holds ``query`` and perhaps ``ORACLE_SQL``.
MODULES = {
    "op1_line_dedup": "line_dedup",
    "op2_secret_scan": "secret_scan",
    "op3_best_fit_packing": "packing",
    "op4_source_mixing": "mixing",
    "op5_hmm_lm": "hmm_lm",
    "op6_simhash_near_dedup": "simhash",
    "op7_substring_dedup": "phrases",
    "op8_quality_rules": "quality",
    "op9_exact_dedup": "exact_dedup",
    "op10_license_scan": "licenses",
}


def queries() -> dict:
    return {name: import_module(f"quadloom.llm.{module}").query for name, module in MODULES.items()}


def oracle_sql() -> dict[str, str]:
    found = {name: getattr(import_module(f"quadloom.llm.{module}"), "ORACLE_SQL", None) for name, module in MODULES.items()}
    return {name: sql for name, sql in found.items() if sql}
