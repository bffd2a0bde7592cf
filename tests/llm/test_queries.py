"""The queries with SQL against it, and the pipeline stage by stage."""

from __future__ import annotations

import corpus_pipeline
import pytest
from compare import differences, duck, duck_rows, spark_rows

from fleetlens.llm import catalog, oracle

DIRECTORY = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(oracle.oracle_sql()))
def test_query_equals_sql(spark, name):
    assert differences(spark_rows(catalog.queries()[name](spark, DIRECTORY)), duck_rows(duck(DIRECTORY), oracle.oracle_sql()[name])) == ""


@pytest.mark.parametrize("name", ["op5_secrets", "op10_personal_data", "op4_chat"])
def test_plans_without_python(spark, name):
    plan = catalog.queries()[name](spark, DIRECTORY)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"))


def test_pipeline(spark):
    docs = spark.read.parquet(f"{DIRECTORY}/documents.parquet")
    whole = docs.count()
    counts = [whole]
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, docs, DIRECTORY)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert made.columns == docs.columns
            docs = made.checkpoint()
        counts.append(made.count())
    assert counts == sorted(counts, reverse=True) and counts[-1] > 0.6 * whole
    assert corpus_pipeline.run(spark, DIRECTORY).count() == counts[-1]
