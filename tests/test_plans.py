"""What Spark makes of the queries."""

import re
from pathlib import Path

import pytest

import __spark_entry__ as entry
from meterlake.plans import catalog

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    df.collect()
    return plan_of(df).split("== Initial Plan ==")[0]


@pytest.mark.parametrize("name", [n for n in catalog.QUERIES if not n.startswith("stream_")])
def test_no_python_and_no_cross_joins(spark, name):
    plan = plan_of(entry.queries()[name](spark, SF_DIR))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEval", "BatchEval"):
        assert operator not in plan


def test_newest_date_is_a_partition_filter(spark):
    """A literal from the folder names: no scan for the date."""
    plan = plan_of(entry.queries()["latest_partition"](spark, SF_DIR))
    assert "PartitionFilters:" in plan and "date" in plan.split("PartitionFilters:")[1]
    assert "subquery" not in plan.lower()


def test_latest_row_is_picked_before_the_shuffle(spark):
    plan = plan_of(entry.queries()["latest_per_meter"](spark, SF_DIR))
    shuffle = plan.index("Exchange hashpartitioning")
    assert "row_number(), 1, Partial" in plan[shuffle:]


@pytest.mark.parametrize("name", ["lake_top500", "recent_log", "forecast_series"])
def test_top_rows_need_no_full_sort(spark, name):
    assert "TakeOrderedAndProject" in plan_of(entry.queries()[name](spark, SF_DIR))


def test_running_totals_divide_meters_by_step(spark):
    """Rows meet by meter and step; only sums per step meet by meter alone."""
    plan = final_plan(entry.queries()["running_energy"](spark, SF_DIR))
    by_step = r"Exchange hashpartitioning\(meter_id#\d+, _step#\d+"
    by_meter = r"Exchange hashpartitioning\((_carry_)?meter_id#\d+, \d+\)"
    assert re.search(by_step, plan)
    below = [m.end() for m in re.finditer(by_meter, plan)]
    assert all("HashAggregate" in plan[at : at + 400] for at in below)


@pytest.mark.parametrize(
    "name,columns",
    [
        ("distinct_meters", "event_id:bigint,ts:timestamp_ntz,user_id:bigint"),
        ("recent_log", "struct<meter_id:string,event_time:timestamp,voltage:double,power:double>"),
    ],
)
def test_scans_read_what_is_needed(spark, name, columns):
    assert columns in plan_of(entry.queries()[name](spark, SF_DIR))
