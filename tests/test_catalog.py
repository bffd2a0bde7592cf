"""Every registered query against its SQL, and the shape of the driver contract."""

from __future__ import annotations

import importlib

import pytest
from compare import differences, duck, duck_rows, spark_rows

from fleetlens.plans import catalog, oracle

DIRECTORY = "/root/testdata/sf0.001"
entry_module = importlib.import_module("__spark_entry__")
QUERIES, SQL = catalog.queries(), oracle.oracle_sql()


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry_module.queries()) and set(SQL) <= set(entry_module.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, name):
    df = QUERIES[name](spark, DIRECTORY)
    assert differences(spark_rows(df), duck_rows(duck(DIRECTORY), SQL[name])) == ""
    # Plans stay in the JVM and join by key.
    plan = df._jdf.queryExecution().executedPlan().toString()
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas"):
        assert operator not in plan


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
