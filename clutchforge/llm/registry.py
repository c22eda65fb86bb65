"""The registered queries of this package and their DuckDB texts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import chat_format, decontaminate, exact_dedup, jaccard_join, license_scan, periodic_runs, quality, source_mix, token_output, topk_search, toxicity, warc, whitening


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_license_scan": license_scan.op1_license_scan,
        "op2_exact_dedup": exact_dedup.op2_exact_dedup,
        "op3_toxicity": toxicity.op3_toxicity,
        "op4_token_output": token_output.op4_token_output,
        "op5_decontaminate": decontaminate.op5_decontaminate,
        "op6_chat_format": chat_format.op6_chat_format,
        "op7_jaccard_join": jaccard_join.op7_jaccard_join,
        "op8_source_mix": source_mix.op8_source_mix,
        "op9_warc": warc.op9_warc,
        "op10_quality": quality.op10_quality,
        "op11_periodic_runs": periodic_runs.op11_periodic_runs,
        "op12_topk_search": topk_search.op12_topk_search,
        "op13_whitening": whitening.op13_whitening,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_license_scan": license_scan.oracle(),
        "op2_exact_dedup": exact_dedup.oracle(),
        "op5_decontaminate": decontaminate.oracle(),
        "op6_chat_format": chat_format.oracle(),
        "op9_warc": warc.oracle(),
        "op11_periodic_runs": periodic_runs.oracle(),
        "op12_topk_search": topk_search.oracle(),
    }
