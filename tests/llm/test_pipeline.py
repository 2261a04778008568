"""The pipeline and the registered queries: SQL where there is some, the stages against the operators' own reports."""

import os
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from harness import compare, duck  # noqa: E402

import corpus_pipeline  # noqa: E402
from rollcall.llm import decontaminate, mixing, near_dedup, quality_rules, registry  # noqa: E402
from rollcall.llm.common import stored, table  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_oracle(spark, name):
    ok, message = compare(registry.QUERIES[name](spark, SF), duck(SF), registry.ORACLE_SQL[name])
    assert ok, message


def test_every_operator_has_one_query():
    assert sorted(int(n[2:].split("_")[0]) for n in registry.QUERIES) == list(range(1, 11))


def test_stages(spark):
    docs = table(spark, SF, "documents").withColumn("quality", F.lit("clash")).withColumn("size", F.lit(None).cast("int"))
    columns = docs.columns
    expected = [
        lambda d: quality_rules.report(d).where("kept").count(),
        lambda d: near_dedup.report(d).select("class_id").distinct().count(),
        lambda d: decontaminate.report(d, table(spark, SF, "benchmark")).where("not contaminated").count(),
        lambda d: mixing.copies(d).agg(F.sum("copies")).first()[0],
        lambda d: d.count(),
    ]
    for (name, stage), count in zip(corpus_pipeline.STAGES, expected):
        out = stored(stage(spark, docs, SF), "stage")
        assert out.count() == count(docs), name
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == columns, name
        docs = out
    starts = [(r.start, r.n_tokens) for r in docs.orderBy("start").collect()]
    assert all(a + n == b for (a, n), (b, _) in zip(starts, starts[1:]))


def test_stages_on_an_empty_table(spark):
    docs = table(spark, SF, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF), "empty")
        assert docs.count() == 0


def test_run(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0
