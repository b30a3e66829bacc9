"""Date parts, rounding, zone cuts and the report rules (FIXTURES §5)."""

import datetime as dt

from pyspark.sql import functions as F

from daycut.functions import labels, timez
from daycut.plans import reports, standins
from daycut.sources import calendar as calmod

D = dt.date


def _one(spark, expr, schema="x long", value=0):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).collect()[0].r


def test_calendar_parts(spark):
    cal = calmod.calendar_days(spark, "2020-12-30", "2023-01-02", "Asia/Seoul")
    rows = {r.date: r for r in cal.collect()}
    assert len(rows) == (D(2023, 1, 2) - D(2020, 12, 30)).days + 1
    assert rows[D(2022, 1, 1)].week == 0 and rows[D(2023, 1, 1)].week == 1
    assert (rows[D(2021, 1, 1)].isoyear, rows[D(2021, 1, 1)].isoweek) == (2020, 53)
    assert rows[D(2022, 1, 2)].dayofweek == 1            # Sunday
    assert rows[D(2021, 5, 16)].date_year_month == "2021-05"
    assert rows[D(2021, 5, 16)].quarter == 2
    assert cal.columns == calmod.CALENDAR_COLUMNS


def test_sunday_week_matches_strftime(spark):
    cal = calmod.calendar_days(spark, "2018-07-01", "2026-12-31")
    for r in cal.select("date", "week").collect():
        assert r.week == int(r.date.strftime("%U")), r.date


def test_empty_calendar(spark):
    assert calmod.calendar_days(spark, "2024-01-02", "2024-01-01").count() == 0


def test_nanos_rounding(spark):
    v = _one(spark, timez.nanos_to_millis(F.col("x")), value=1591401599999600000)
    assert v == 1591401600000
    assert _one(spark, timez.round_long(F.lit(2.5))) == 3
    assert _one(spark, timez.round_long(F.lit(-2.5))) == -3


def _ms(y, mo, d, h, mi, tz_hours=9):
    return int((dt.datetime(y, mo, d, h, mi, tzinfo=dt.timezone.utc)
                - dt.timedelta(hours=tz_hours)).timestamp() * 1000)


def test_sleep_day_cut(spark):
    rows = [("u", _ms(2024, 1, 10, 18, 59), _ms(2024, 1, 10, 19, 20), "a", 72),
            ("u", _ms(2024, 1, 10, 19, 0), _ms(2024, 1, 10, 19, 30), "a", 72),
            # two apps on one day: the larger per-app total wins
            ("u", _ms(2024, 1, 12, 1, 0), _ms(2024, 1, 12, 1, 30), "a", 72),
            ("u", _ms(2024, 1, 12, 2, 0), _ms(2024, 1, 12, 3, 0), "b", 109),
            ("u", _ms(2024, 1, 12, 2, 0), _ms(2024, 1, 12, 3, 0), "b", 109),  # duplicate
            ("u", _ms(2024, 1, 12, 5, 0), _ms(2024, 1, 12, 6, 0), "a", 7)]    # not sleep
    s = spark.createDataFrame(rows, "user_id string, startTimeMillis long, endTimeMillis long,"
                                    " application_packageName string, activityType long")
    cal = calmod.calendar_days(spark, "2024-01-09", "2024-01-13")
    out = {r.date: r.sleep_sec for r in
           reports.daily_sleep(s, cal, start="2024-01-09", end="2024-01-13").collect()}
    assert out[D(2024, 1, 10)] == 21 * 60
    assert out[D(2024, 1, 11)] == 30 * 60
    assert out[D(2024, 1, 12)] == 3600
    assert out[D(2024, 1, 9)] is None and out[D(2024, 1, 13)] is None


def test_working_hours(spark):
    def label(y, mo, d, h, mi):
        ts = dt.datetime(y, mo, d, h, mi)
        return spark.createDataFrame([(ts,)], "t timestamp") \
            .select(labels.working_hours_label("t").alias("r")).collect()[0].r
    w, o = labels.WORKING_LABEL, labels.OUTSIDE_WORKING_LABEL
    assert label(2024, 1, 8, 9, 0) == w          # Monday
    assert label(2024, 1, 8, 19, 59) == w
    assert label(2024, 1, 8, 8, 59) == o
    assert label(2024, 1, 8, 20, 0) == o
    assert label(2024, 1, 7, 12, 0) == o         # Sunday


def _activities(spark):
    rows = [("u", _ms(2024, 1, 8, 10, 0), 100, "a", "c", "productive", 1),
            ("u", _ms(2024, 1, 8, 21, 0), 50, "a", "c", "very productive", 2),
            ("u", _ms(2024, 1, 8, 11, 0), 70, "b", "c", "neutral", 0),
            ("u", _ms(2024, 1, 7, 11, 0), 30, "a", "c", "productive", 1)]
    return spark.createDataFrame(rows, "user_id string, date_timestamp_millis long,"
                                       " time_spent_seconds long, activity string,"
                                       " category string, productivity_string string,"
                                       " productivity long")


def test_daily_productive_and_empty_days(spark):
    cal = calmod.calendar_days(spark, "2024-01-06", "2024-01-09")
    out = {r.date: r for r in reports.daily_productive(
        _activities(spark), cal, start="2024-01-06", end="2024-01-09").collect()}
    assert (out[D(2024, 1, 8)].working_time_sec, out[D(2024, 1, 8)].outside_working_time_sec,
            out[D(2024, 1, 8)].total_time_sec) == (100, 50, 150)
    assert out[D(2024, 1, 7)].outside_working_time_sec == 30
    assert out[D(2024, 1, 6)].total_time_sec == 0


def test_details_empty_day_gives_one_null_row(spark):
    cal = calmod.calendar_days(spark, "2024-01-06", "2024-01-09")
    rows = reports.daily_productive_details(_activities(spark), cal,
                                            start="2024-01-06", end="2024-01-09").collect()
    empty = [r for r in rows if r.date == D(2024, 1, 6)]
    assert len(empty) == 1 and empty[0].time_sec is None and empty[0].category is None
    assert len([r for r in rows if r.date == D(2024, 1, 8)]) == 2


def test_unbounded_calendar_works_without_literal_range(spark):
    cal = calmod.calendar_days(spark, "2024-01-06", "2024-01-09")
    a = reports.daily_productive(_activities(spark), cal).collect()
    b = reports.daily_productive(_activities(spark), cal, start="2024-01-06",
                                 end="2024-01-09").collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_calendar_until_yesterday(spark):
    cal = reports.calendar_report(spark, start="2024-01-01", tz="Asia/Seoul")
    first = cal.collect()[0]
    import zoneinfo
    today = dt.datetime.now(zoneinfo.ZoneInfo("Asia/Seoul")).date()
    assert first.date == today - dt.timedelta(days=1)
    assert isinstance(first.date, dt.date) and not isinstance(first.date, dt.datetime)


def test_day_partition_pruning_filter(spark, tmpdir_path):
    """Reports over a warehouse table push the time range to the scan and
    prune day partitions."""
    import os
    from daycut.sinks import warehouse
    table = os.path.join(tmpdir_path, "acts")
    acts = _activities(spark)
    for day in ("2024-01-07", "2024-01-08"):
        warehouse.load_partition(acts, table, day)
    t = warehouse.read_table(spark, table)
    cal = calmod.calendar_days(spark, "2024-01-08", "2024-01-08")
    df = reports.daily_productive(t, cal, start="2024-01-08", end="2024-01-08",
                                  day_col="day")
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    try:
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "PartitionFilters: [isnotnull(day" in plan
    assert "GreaterThanOrEqual(date_timestamp_millis" in plan
    assert "BroadcastHashJoin" in plan


def test_daily_totals_equal_fact_total(spark):
    """Property: the report's daily totals add up to the facts whose local
    date lies in the calendar (whole sf0.01 events table)."""
    from conftest import SF001
    from daycut.plans import catalog, standins
    pts = standins.points_from_events(standins.read_events(spark, SF001))
    rep = catalog.q_daily_steps(spark, SF001)
    total = rep.agg(F.sum("step_count")).collect()[0][0]
    d = timez.local_date(timez.millis_to_instant(timez.nanos_to_millis("startTimeNanos")),
                         catalog.TZ)
    want = pts.filter((F.col("dataTypeName") == standins.STEP_TYPE)
                      & d.between(F.lit(D(2023, 12, 25)), F.lit(D(2024, 2, 5)))) \
        .agg(F.sum("value0_intVal")).collect()[0][0]
    assert total == want and total > 0
    assert rep.count() == pts.select(d).distinct().count()       # the days that the events span


def test_working_hours_parameters(spark):
    cal = calmod.calendar_days(spark, "2024-01-06", "2024-01-09")
    out = {r.date: r for r in reports.daily_productive(
        _activities(spark), cal, start="2024-01-06", end="2024-01-09",
        working=((1, 2, 3, 4, 5, 6, 7), 0, 23)).collect()}
    assert out[D(2024, 1, 8)].working_time_sec == 150
    assert out[D(2024, 1, 7)].working_time_sec == 30


def test_details_by_user_has_a_null_row_per_user_and_empty_day(spark):
    cal = calmod.calendar_days(spark, "2024-01-06", "2024-01-09")
    acts = _activities(spark).unionByName(
        spark.createDataFrame([("v", _ms(2024, 1, 9, 10, 0), 5, "a", "c", "productive", 1)],
                              _activities(spark).schema))
    rows = reports.daily_productive_details(acts, cal, start="2024-01-06", end="2024-01-09",
                                            by_user=True).collect()
    nulls = sorted((r.user_id, r.date) for r in rows if r.time_sec is None)
    assert nulls == [("u", D(2024, 1, 6)), ("u", D(2024, 1, 9)),
                     ("v", D(2024, 1, 6)), ("v", D(2024, 1, 7)), ("v", D(2024, 1, 8))]


def test_empty_day_results_v2_to_v5(spark):
    """A calendar day without facts: distance and steps give 0, calories and
    heart rate give NULL (FIXTURES §5)."""
    ns = _ms(2024, 1, 8, 10, 0) * 1_000_000
    rows = [("u", "s", ns, ns + 60_000_000_000, t, v, i) for t, v, i in [
        ("com.google.step_count.delta", None, 10),
        ("com.google.distance.delta", 2.5, None),
        ("com.google.calories.expended", 1.5, None),
        ("com.google.heart_rate.summary", 60.5, None)]]
    pts = spark.createDataFrame(rows, "user_id string, dataSourceId string, startTimeNanos long,"
                                      " endTimeNanos long, dataTypeName string,"
                                      " value0_fpVal double, value0_intVal long")
    cal = calmod.calendar_days(spark, "2024-01-07", "2024-01-08")
    kw = dict(start="2024-01-07", end="2024-01-08")

    def by_day(df, col):
        return {r.date: r[col] for r in df.collect()}
    assert by_day(reports.daily_steps(pts, cal, **kw), "step_count") == {
        D(2024, 1, 7): 0, D(2024, 1, 8): 10}
    assert by_day(reports.daily_distance(pts, cal, **kw), "distance") == {
        D(2024, 1, 7): 0, D(2024, 1, 8): 3}                  # 2.5 rounds half away from zero
    assert by_day(reports.daily_calories(pts, cal, **kw), "calrories") == {
        D(2024, 1, 7): None, D(2024, 1, 8): 2}
    hr = {r.date: r for r in reports.daily_heart_rate(pts, cal, **kw).collect()}
    assert hr[D(2024, 1, 7)].avg_heart_rate is None
    assert (hr[D(2024, 1, 8)].avg_heart_rate, hr[D(2024, 1, 8)].min_heart_rate,
            hr[D(2024, 1, 8)].max_heart_rate) == (61, 61, 61)


def test_text_time_parsers(spark):
    df = spark.createDataFrame([("2020-06-06T23:59:59.99Z", "2020-05-16T09:00:00")],
                               "a string, b string")
    r = df.select(timez.parse_rfc3339_millis("a").alias("a"),
                  timez.parse_local_millis("b", "Asia/Seoul").alias("b")).collect()[0]
    assert r.a == 1591487999990
    assert r.b == 1589587200000
    bad = spark.createDataFrame([("nope",)], "a string") \
        .select(timez.parse_rfc3339_millis("a").alias("a")).collect()[0]
    assert bad.a is None


def test_one_scan_v7_equals_two_join_v7(spark):
    """SURVEY §5 property: the rewritten V7 equals its original two-join shape
    on the whole sf0.01 events table."""
    from conftest import SF001
    from daycut.plans import catalog, standins
    acts = standins.activities_from_events(standins.read_events(spark, SF001))
    cal = calmod.calendar_days(spark, "2023-12-25", "2024-02-05", catalog.TZ)
    kw = dict(start="2023-12-25", end="2024-02-05", tz=catalog.TZ)
    one = sorted(map(tuple, reports.daily_productive(acts, cal, ordered=False, **kw).collect()))
    two = sorted(map(tuple, reports.daily_productive_two_joins(acts, cal, **kw).collect()))
    assert one == two and len(one) == 43


def test_details_materialized_equals_rescan(spark):
    """V8 with the grouped facts checkpointed gives the same rows, and the
    facts are scanned once."""
    from conftest import SF001
    from daycut.plans import catalog, standins
    acts = standins.activities_from_events(standins.read_events(spark, SF001))
    cal = calmod.calendar_days(spark, "2023-12-25", "2024-02-05", catalog.TZ)
    kw = dict(start="2023-12-25", end="2024-02-05", tz=catalog.TZ, ordered=False)
    a = reports.daily_productive_details(acts, cal, **kw)
    b = reports.daily_productive_details(acts, cal, materialize=True, **kw)
    assert sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))
    plan = b._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in plan          # both branches read the checkpoint


def test_by_user_with_a_table_of_users(spark):
    rows = [(None, 1), ("a", 2), ("b", 4)]
    ns = 1_704_853_800_000_000_000                               # 2024-01-10 11:30 in Seoul
    points = spark.createDataFrame([(u, standins.STEP_TYPE, ns, None, n) for u, n in rows],
                                   "user_id string, dataTypeName string, startTimeNanos long, "
                                   "value0_fpVal double, value0_intVal long")
    cal = calmod.calendar_days(spark, "2024-01-10", "2024-01-11", "Asia/Seoul")
    kw = {"tz": "Asia/Seoul", "start": "2024-01-10", "end": "2024-01-11", "by_user": True}
    got = lambda df: {(r.user_id, str(r.date), r.step_count) for r in df.collect()}
    days = ("2024-01-10", "2024-01-11")
    assert got(reports.daily_steps(points, cal, **kw)) == {
        (u, d, n if d == days[0] else 0) for u, n in rows for d in days}
    users = spark.createDataFrame([("a",), ("z",)], "user_id string")
    assert got(reports.daily_steps(points, cal, users=users, **kw)) == {
        ("a", days[0], 2), ("a", days[1], 0), ("z", days[0], 0), ("z", days[1], 0)}
