"""What the optimizer must have done."""

import re

from orderlens.operators import basket, profiling
from orderlens.plans import catalog
from orderlens.plans.inputs import Inputs
from orderlens.sources import retail

FOLDER = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(spark):
    plan = plan_of(catalog.queries()["monthly_revenue"](spark, FOLDER))
    assert re.search(r"PushedFilters: \[[^\]]*IsNotNull\(l_orderkey\)", plan)
    assert "l_tax" not in plan and "o_totalprice" not in plan and "p_size" not in plan


def test_rank_filters_run_before_the_shuffle(spark):
    raw = retail.raw_lines(spark, FOLDER)
    for df in (profiling.top_values(raw), basket.basket_items(Inputs(spark, FOLDER).sales, 10)):
        assert re.search(r"WindowGroupLimit .*Partial", plan_of(df))
