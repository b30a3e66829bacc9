"""Plan properties that keep the queries fit for large inputs."""

import re

import pytest

import __spark_entry__ as ent
from conftest import SF001

REPORTS = ["daily_calories", "daily_distance", "daily_steps", "daily_heart_rate",
           "daily_sleep", "daily_productive"]
# load queries write while they are built; their plan is only the read-back
PLANNED = [n for n in ent.queries() if not n.startswith(("load_", "lake_", "land"))]


def _plan(df, optimized=False):
    qe = df._jdf.queryExecution()
    return (qe.optimizedPlan() if optimized else qe.executedPlan()).toString()


@pytest.mark.parametrize("name", PLANNED)
def test_no_python_and_no_cartesian(spark, name):
    plan = _plan(ent.queries()[name](spark, SF001))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct",
                "BroadcastNestedLoopJoin"):
        assert bad not in plan, (name, bad)


@pytest.mark.parametrize("name", REPORTS)
def test_reports_aggregate_before_a_broadcast_join(spark, name):
    plan = _plan(ent.queries()[name](spark, SF001))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert re.search(r"partial_(sum|max|min|count)", plan), "no map-side partial aggregate"


def test_flatten_parses_each_line_once(spark):
    for name in ("flatten_time_tracking", "split_rejects", "parse_sessions"):
        plan = _plan(ent.queries()[name](spark, SF001), optimized=True)
        # the lake-line parse (one from_json on the line) is not repeated per column
        assert plan.count("from_json") <= 2, (name, plan.count("from_json"))


def test_details_report_scans_the_facts_once(spark):
    df = ent.queries()["daily_productive_details"](spark, SF001)
    df.collect()                                      # the final plan shows what is reused
    final = _plan(df).split("== Initial Plan ==")[0]
    # the facts and the calendar's range each read the table
    assert final.count("ReusedExchange") >= 1 and final.count("FileScan parquet") <= 2, final
