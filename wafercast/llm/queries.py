"""Registered queries of this subpackage and their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (decontamination, exact_dedup, language_id, line_dedup, mixing, near_dedup, packing, quality, sharding,
               spelling, suffix_dedup, token_counts, whitening)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_token_counts": token_counts.op1_token_counts,
        "op2_minhash_dedup": near_dedup.op2_minhash_dedup,
        "op3_suffix_dedup": suffix_dedup.op3_suffix_dedup,
        "op4_exact_dedup": exact_dedup.op4_exact_dedup,
        "op5_best_fit_packing": packing.op5_best_fit_packing,
        "op6_mixing": mixing.op6_mixing,
        "op7_line_runs": line_dedup.op7_line_runs,
        "op8_language_id": language_id.op8_language_id,
        "op9_quality_rules": quality.op9_quality_rules,
        "op10_kd_sharding": sharding.op10_kd_sharding,
        "op11_whitening": whitening.op11_whitening,
        "op12_spelling_variants": spelling.op12_spelling_variants,
        "op13_decontamination": decontamination.op13_decontamination,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op4_exact_dedup": exact_dedup.ORACLE,
        "op6_mixing": mixing.ORACLE,
        "op7_line_runs": line_dedup.ORACLE,
        "op9_quality_rules": quality.ORACLE,
        "op13_decontamination": decontamination.ORACLE,
    }
