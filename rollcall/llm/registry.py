"""The registered queries of this package and their DuckDB statements."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from rollcall.llm import (chat_format, decontaminate, hard_negatives, jaccard_join, mixing, near_dedup, pii, quality_rules,
                          secret_scan, token_files, token_lengths, toxicity, whitening)
from rollcall.llm.common import table


def _over(function, *names: str) -> Callable[[SparkSession, str], DataFrame]:
    """A query that applies ``function`` to whole tables."""
    return lambda spark, sf_dir: function(*[table(spark, sf_dir, n) for n in names])


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_chat_format": _over(chat_format.report, "conversations"),
    "op2_decontaminate": _over(decontaminate.report, "documents", "benchmark"),
    "op3_secret_scan": _over(secret_scan.report, "documents"),
    "op4_near_dedup": _over(near_dedup.report, "documents"),
    "op5_pii": _over(pii.report, "documents"),
    "op6_quality_rules": _over(quality_rules.report, "documents"),
    "op7_token_files": _over(token_files.report, "documents"),
    "op8_toxicity": _over(toxicity.report, "documents", "labels"),
    "op9_mixing": _over(mixing.report, "documents"),
    "op10_token_lengths": _over(token_lengths.report, "documents"),
    "op11_whitening": _over(whitening.report, "embeddings"),
    "op12_jaccard_join": _over(jaccard_join.report, "documents"),
    "op13_hard_negatives": _over(hard_negatives.report, "embeddings"),
}

ORACLE_SQL: dict[str, str] = {
    "op2_decontaminate": decontaminate.ORACLE_SQL,
    "op6_quality_rules": quality_rules.oracle_sql(),
    "op12_jaccard_join": jaccard_join.ORACLE_SQL,
    "op13_hard_negatives": hard_negatives.ORACLE_SQL,
}
