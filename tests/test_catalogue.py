"""Every registered query against its SQL oracle on the smallest data, and rules on all plans."""

import pytest

import __spark_entry__ as entry_module
from keystrata.catalogue import ORACLES, QUERIES
from tools.compare import difference, oracle_connection

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle_connection(SMALL)


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_its_oracle(spark, con, name):
    df = QUERIES[name](spark, SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EvalPython" not in plan and "CartesianProduct" not in plan and "MapInPandas" not in plan
    assert name in ORACLES
    assert difference(df, con, ORACLES[name]) is None


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0


def test_names():
    assert set(QUERIES) <= set(entry_module.queries()) and set(ORACLES) <= set(entry_module.oracle_sql())
    assert not set(entry_module.oracle_sql()) - set(entry_module.queries())


def test_scans_read_only_what_they_need(spark, plan_of):
    plan = plan_of(QUERIES["current_view_orders"](spark, SMALL))
    assert "ReadSchema: struct<c_custkey:bigint,c_name:string>" in plan
    assert "o_totalprice" not in plan and "o_orderpriority" not in plan
    plan = plan_of(QUERIES["count_distinct_in_range"](spark, SMALL))
    assert "GreaterThanOrEqual(o_orderdate" in plan and "ReadSchema: struct<o_custkey:bigint,o_orderdate:timestamp_ntz>" in plan
