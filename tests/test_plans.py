"""Physical-plan checks: no Cartesian / nested-loop joins, no Python UDFs, pruned scans."""

import os
import re

import pytest

import __spark_entry__ as E
from panelmart.registry import REGISTRY

SF = os.environ.get("PANELMART_TEST_SF", "/root/testdata/sf0.001")
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "PythonUDF")


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_plan_has_no_cartesian_or_python(spark, name):
    df = E.queries()[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [f for f in FORBIDDEN if f in plan]


def test_fact_scans_are_pruned(spark):
    from panelmart.registry import catalog_for
    from panelmart.sources.standin import unit_year

    df = unit_year(catalog_for(spark, SF))
    plan = df._jdf.queryExecution().executedPlan().toString()
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    li = [s for s in schemas if "l_orderkey" in s]
    assert li and all("l_shipdate" not in s and "l_returnflag" not in s and "l_partkey" not in s for s in li)
    orders = [s for s in schemas if "o_orderkey" in s]
    assert orders and all("o_orderdate" in s for s in orders)


def test_year_restricted_fact_pushes_a_date_range(spark):
    from panelmart.registry import catalog_for
    from panelmart.sources.standin import unit_year

    df = unit_year(catalog_for(spark, SF), [2000])
    plan = df._jdf.queryExecution().executedPlan().toString()
    pushed = [p for p in re.findall(r"PushedFilters: \[([^\]]*)\]", plan) if "o_orderdate" in p]
    assert pushed and "GreaterThanOrEqual(o_orderdate" in pushed[0] and "LessThan(o_orderdate" in pushed[0]
    assert {r.year for r in df.select("year").distinct().collect()} <= {2000}


def test_bucketed_fact_panel_join_has_no_exchange(spark):
    from panelmart.plans.panel import yoy_panel
    from panelmart.sources.standin import unit_year
    from panelmart.sources.tables import Catalog, materialize_table

    fact = materialize_table(spark, unit_year(Catalog(spark, SF)), "test-bucketed-fact", ["year"], ["unit_id", "company"])
    p = yoy_panel(fact, ["unit_id", "company"], "year", 2000, ["market_value"])
    plan = p._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
