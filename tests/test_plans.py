"""Physical-plan checks over the queries of the reports and their operators."""

import pytest

import __spark_entry__ as entry
from tablero.plans.standins import REGISTRY

SF = "/root/testdata/sf0.001"
FORBIDDEN = ["BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"]


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_plan_stays_in_the_jvm_and_has_no_pair_products(spark, name):
    df = REGISTRY[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for node in FORBIDDEN:
        assert node not in plan, f"{name}: {node}"


def test_filters_and_columns_reach_the_scan(spark):
    df = entry.queries()["filter_basic"](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_orderstatus), IsNotNull(o_orderpriority), EqualTo(o_orderstatus,F)" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string,o_orderpriority:string>" in plan
