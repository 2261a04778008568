"""The corpus pipeline: quality rules, near duplicates, benchmark passages, source mix, token files.

Every stage takes (spark, docs, sf_dir) and works on all rows that the stage before it kept.  All but the last
return the columns of ``documents``; :func:`run` writes each stage's rows as Parquet in the shared folder and hands
the next stage what it reads back, so an executor lost in one stage costs nothing of the stages before.

Empty tables, null columns, empty and very long texts, repeated rows and extra columns are handled as the operators
define them (see the modules of ``rollcall.llm``): a document without words goes in the first stage, and of
identical rows one stays in the second.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rollcall.llm import decontaminate, mixing, near_dedup, quality_rules, token_files
from rollcall.llm.common import stored, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the threshold table keeps."""
    return quality_rules.accepted(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return near_dedup.deduplicate(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth lies in benchmark windows."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of all documents, read back: doc_id, start, n_tokens and ids_crc32."""
    return token_files.report(docs)


STAGES = [("quality rules", quality), ("near duplicates", near_duplicates), ("decontamination", decontamination),
          ("mixing", mix), ("token files", tokens)]

#: Near duplicates, the random draws of the mix and the tokenizer can't be said in SQL; tests/llm compares with plain code.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the rows of the last one."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
