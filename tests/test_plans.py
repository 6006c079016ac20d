"""Physical plans: narrow scans, pushed filters, no nested loops, no Python in relational queries."""

import re

import pytest

import __spark_entry__ as entry
from lectern.operators import activity
from lectern.plans.bindings import Inputs

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def read_schemas(plan, table):
    return [set(re.findall(r"(\w+):", m)) for m in re.findall(rf"{table}\.parquet.*?ReadSchema: struct<([^>]*)>", plan)]


@pytest.mark.parametrize("name,table,columns", [
    ("video_stats", "lineitem", {"l_orderkey", "l_partkey", "l_quantity", "l_returnflag"}),
    ("user_growth_daily", "orders", {"o_custkey", "o_orderdate"}),
    ("badge_summary", "orders", {"o_custkey", "o_orderdate", "o_orderpriority", "o_totalprice"}),
    ("trimmed_mean", "lineitem", {"l_quantity", "l_returnflag", "l_linestatus"}),
])
def test_scans_read_only_what_is_used(spark, name, table, columns):
    schemas = read_schemas(plan_of(entry.queries()[name](spark, SF)), table)
    assert schemas and all(s <= columns for s in schemas), schemas


def test_filters_reach_the_scan(spark):
    b = Inputs(spark, SF)
    plan = plan_of(activity.user_video_summary(b.view_log))
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,view)" in plan


@pytest.mark.parametrize("name", [
    "user_daily_activity", "company_metrics", "daily_video_stats", "daily_exercise_stats", "rolling_active_teachers", "most_active_coaches",
    "ip_geolocate", "assign_alternative", "cooccurrence", "url_latency_stats", "auc_logloss", "best_threshold", "retention_cohorts", "exercise_drilldown"])
def test_no_nested_loops_and_no_python(spark, name):
    plan = plan_of(entry.queries()[name](spark, SF))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas"):
        assert operator not in plan


def test_scans_of_one_pass_operators(spark):
    """The twelve combinations of level and user category come from at most two reads of the usage: one for
    the labelled levels, one for the totals."""
    plan = plan_of(entry.queries()["video_stats"](spark, SF))
    assert plan.count("lineitem.parquet") <= 2


def test_address_lookup_expands_nothing(spark):
    plan = plan_of(entry.queries()["ip_geolocate"](spark, SF))
    assert "Generate" not in plan and "explode" not in plan
