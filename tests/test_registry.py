"""Every registered query against its SQL on the smallest tables, and plan checks on all of them."""

import pytest

from checks import registry
from checks.compare import compare, connect

# Training many rounds takes longer than all the rest; these run in the comparison of all queries.
SLOW = {"trn_3", "trn_4"}


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - SLOW))
def test_query_equals_sql_without_cross_joins(spark, sf, con, name):
    df = registry.QUERIES[name](spark, sf)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    rows, problem = compare(con, df, registry.SQL[name])
    assert problem is None, problem
    assert rows > 0


def test_filters_and_columns_reach_the_scan(spark, sf):
    plan = registry.QUERIES["cln_2"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(l_returnflag,R)" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_returnflag:string>" in plan


def test_every_query_has_sql():
    assert set(registry.QUERIES) == set(registry.SQL)
