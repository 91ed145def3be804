"""Every query of the catalog against its SQL counterpart, and the shape of its plan."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from signalweave import catalog
from tests.compare import differences, oracle

FOLDER = contract.SMALL
QUERIES, SQL = catalog.queries(), catalog.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return oracle(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    assert differences(QUERIES[name](spark, FOLDER), con, SQL[name]) == []


def test_contract_has_the_catalog():
    assert set(QUERIES) <= set(contract.queries()) and set(SQL) <= set(contract.oracle_sql())
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).columns[:3] == ["country", "category", "time_month"]


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.startswith("stream_")))
def test_plans_stay_in_the_jvm_without_cross_joins(spark, name):
    """Also with broadcasts off, as for tables too large to broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    for word in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin", "BroadcastExchange"):
        assert word not in text
