"""Report views whose calendar ends yesterday when they are queried, and the
user dimension of per-user reports."""

import json
import os
import time

import pytest
from pyspark.sql import functions as F

from daycut.plans import jobs, reports, views
from daycut.sinks import lake, users, warehouse
from daycut.sources import calendar as calmod

DAY = "2024-01-09"


def fill(spark, root, day, steps):
    """Lake lines of step points, (user, hour, count), of a UTC day."""
    base = 1704758400000 + 86_400_000 * (int(day[-2:]) - 9)
    lines = [(day, "aggregated-datasets", json.dumps({
        "user_id": u, "dataSourceId": "d", "startTimeNanos": f"{base + h * 3_600_000}000000",
        "endTimeNanos": f"{base + h * 3_600_000 + 60_000}000000", "dataTypeName": "com.google.step_count.delta",
        "value": [{"intVal": n}]})) for u, h, n in steps]
    lake.write_sharded_jsonl(spark.createDataFrame(lines, "day string, dataset string, value string")
                             .withColumn("day", F.col("day").cast("date")), root)


def load(spark, root, tables, day):
    return jobs.load_windows(spark, root, tables, [jobs.day_window(day)])


def plan(spark, sql):
    return spark.sql(sql)._jdf.queryExecution().executedPlan().toString()


def fast_clock(seconds_per_day):
    """A clock that starts at noon of the 10th and runs a day in seconds."""
    t0 = int(time.time() * 1000)
    gone = F.unix_millis(F.current_timestamp()) - F.lit(t0)
    return F.timestamp_millis(F.lit(1704888000000) + gone * F.lit(int(86_400 / seconds_per_day)))


def test_view_moves_with_the_date(spark, tmpdir_path):
    root, tables = os.path.join(tmpdir_path, "lake"), {"points": os.path.join(tmpdir_path, "points")}
    fill(spark, root, DAY, [("u1", 1, 42)])
    fill(spark, root, "2024-01-11", [("u1", 1, 7)])
    for day in (DAY, "2024-01-11"):
        load(spark, root, tables, day)
    begun = time.time()
    views.register_views(spark, tables, start="2024-01-08", end=calmod.yesterday("UTC", fast_clock(20)), tz="UTC", prefix="mv_")
    assert "PartitionFilters: [isnotnull(day" in plan(spark, "SELECT * FROM mv_daily_steps")
    first = {str(r.date): r.step_count for r in spark.sql("SELECT * FROM mv_daily_steps").collect()}
    assert min(first) == "2024-01-08" and first[DAY] == 42
    time.sleep(max(0, 65 - (time.time() - begun)))
    later = {str(r.date): r.step_count for r in spark.sql("SELECT * FROM mv_daily_steps").collect()}
    assert len(later) > len(first) and later["2024-01-11"] == 7 and max(later) > max(first)


def test_default_end_is_yesterday(spark, tmpdir_path):
    root, tables = os.path.join(tmpdir_path, "lake"), {"points": os.path.join(tmpdir_path, "points")}
    fill(spark, root, DAY, [("u1", 1, 42)])
    load(spark, root, tables, DAY)
    views.register_views(spark, tables, start="2024-01-08", prefix="yd_")
    last, today = spark.sql("SELECT max(date), to_date(from_utc_timestamp(current_timestamp(), 'Asia/Seoul')) FROM yd_daily_steps").first()
    assert (today - last).days == 1
    shown = plan(spark, "SELECT * FROM yd_daily_steps")
    assert "current_timestamp" not in shown and "PartitionFilters: [isnotnull(day" in shown


def test_view_over_a_named_table_sees_later_loads(spark, tmpdir_path):
    root, tag = os.path.join(tmpdir_path, "lake"), os.path.basename(tmpdir_path).replace("-", "_").lower()
    spark.sql(f"CREATE DATABASE {tag} LOCATION '{tmpdir_path}/db'")
    try:
        tables = {"points": f"{tag}.points"}
        fill(spark, root, DAY, [("u1", 1, 42)])
        load(spark, root, tables, DAY)
        views.register_views(spark, tables, start="2024-01-08", end="2024-01-12", tz="UTC", prefix="nt_")
        assert spark.sql("SELECT sum(step_count) FROM nt_daily_steps").first()[0] == 42
        fill(spark, root, "2024-01-11", [("u1", 1, 7)])
        load(spark, root, tables, "2024-01-11")
        assert spark.sql("SELECT sum(step_count) FROM nt_daily_steps").first()[0] == 49
    finally:
        spark.sql(f"DROP DATABASE {tag} CASCADE")


def test_user_dimension_is_merged_by_loads(spark, tmpdir_path):
    root, tables = os.path.join(tmpdir_path, "lake"), {"points": os.path.join(tmpdir_path, "points")}
    fill(spark, root, DAY, [("u1", 1, 4), ("u2", 2, 5)])
    fill(spark, root, "2024-01-12", [("u2", 1, 6), ("u3", 1, 7)])
    for day in ("2024-01-12", DAY):
        load(spark, root, tables, day)
    got = {r.user_id: (str(r.first_day), str(r.last_day)) for r in users.read_users(spark, tables["points"]).collect()}
    assert got == {"u1": (DAY, DAY), "u2": (DAY, "2024-01-12"), "u3": ("2024-01-12", "2024-01-12")}
    assert users.read_users(spark, os.path.join(tmpdir_path, "none")) is None
    # every scan of a bounded per-user view is pruned: the facts by day, the users by their first day
    views.register_views(spark, tables, start=DAY, end="2024-01-10", tz="UTC", by_user=True, prefix="ud_")
    shown = plan(spark, "SELECT * FROM ud_daily_steps")
    scans = [x for x in shown.splitlines() if "FileScan parquet" in x]
    facts = [x for x in scans if "points_users" not in x]
    assert len(facts) == 1 and "day" in facts[0].split("PartitionFilters: [")[1].split("]")[0]
    rows = spark.sql("SELECT user_id, date, step_count FROM ud_daily_steps").collect()
    assert sorted((r.user_id, str(r.date), r.step_count) for r in rows) == [
        ("u1", DAY, 4), ("u1", "2024-01-10", 0), ("u2", DAY, 5), ("u2", "2024-01-10", 0)]


@pytest.mark.parametrize("tz", ["UTC", "Asia/Seoul", "America/New_York"])
def test_expression_bounds_equal_literal_bounds(spark, tz):
    rows = spark.range(400).select(
        F.concat(F.lit("u"), F.col("id") % 3).alias("user_id"), F.lit("com.google.step_count.delta").alias("dataTypeName"),
        (F.lit(1709251200000) + F.col("id") * 3_600_000).alias("ms"), F.col("id").alias("value0_intVal"),
        F.lit(1.5).alias("value0_fpVal")).withColumn("startTimeNanos", F.col("ms") * 1_000_000) \
        .withColumn("day", F.to_date(F.timestamp_millis("ms")))
    for report in (reports.daily_steps, reports.daily_distance):
        got = []
        for start, end in (("2024-03-05", "2024-03-12"), (F.lit("2024-03-05").cast("date"), F.lit("2024-03-12").cast("date"))):
            cal = calmod.calendar_days(spark, start, end, tz)
            for by_user in (False, True):
                out = report(rows, cal, tz=tz, start=start, end=end, day_col="day", by_user=by_user)
                got.append(sorted(map(tuple, out.collect())))
        assert got[0] == got[2] and got[1] == got[3] and len(got[0]) == 8 and len(got[1]) == 24
