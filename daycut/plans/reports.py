"""The daily reports (V1–V8) and the 30-minute point buckets.

Each report takes the warehouse table(s) and a calendar frame.  ``start`` and
``end`` are the calendar's bounds when known, dates or expressions that fold to
a date when the query runs (``calendar.yesterday``): they turn into a range
filter on the raw time column (pushed to the Parquet scan of a warehouse
table, and to day-partition pruning when ``day_col`` names the partition
column) and into the proven row bound that allows broadcasting per-day rows.
``user_id=None`` reports over all users (the single-user form filters);
``by_user=True`` gives one dense series per user of the table instead.
Outputs are ordered newest day first, as the warehouse views are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daycut.functions import labels, timez
from daycut.operators import daily, exact
from daycut.plans import standins
from daycut.session import checkpointed
from daycut.sources import calendar as calmod

TZ = "Asia/Seoul"
SLEEP_SHIFT_HOURS = 5  # sleep that starts from 19:00 local counts to the next day


def _bound(start, end) -> int | None:
    if start is None or end is None:
        return None
    return calmod.day_count(start, end)


def _prune(df: DataFrame, time_col: str, unit_per_ms: int, start, end, tz: str,
           day_col: str | None, pad_ms: int = 1) -> DataFrame:
    """Keep facts whose instant can fall on a local day in ``start..end``.

    The exact local-date test follows after the date is computed; this coarse
    half-open range on the raw column is what reaches the scan.
    """
    if start is None or end is None:
        return df
    lo, hi = (F.lit(lo) if isinstance(lo, int) else lo for lo in timez.local_range_millis(start, end, tz))
    lo, hi = lo - F.lit(pad_ms), hi + F.lit(pad_ms)
    df = df.filter(daily.in_range(F.col(time_col), lo * F.lit(unit_per_ms), hi * F.lit(unit_per_ms)))
    if day_col:
        # a day on each side: rows may lie in the partition of a neighbouring day
        df = df.filter(F.col(day_col).between(F.date_sub(_utc_day(lo), 1), F.date_add(_utc_day(hi), 1)))
    return df


def _utc_day(ms: Column) -> Column:
    return F.to_date(timez.millis_to_instant(ms))


def _in_calendar(date: Column, start, end) -> Column:
    if start is None or end is None:
        return date.isNotNull()
    return date.between(calmod.date_col(start), calmod.date_col(end))


def _user(df: DataFrame, user_id) -> DataFrame:
    return df if user_id is None else df.filter(F.col("user_id") == F.lit(user_id))


def newest_first(df: DataFrame, ordered: bool, bounded: bool = False) -> DataFrame:
    """Newest day first (per user for per-user reports).  Outputs bounded by
    the calendar (one row per day) are sorted in one partition — no
    range-partitioning sample job; outputs that grow with the facts or the
    users use a global sort."""
    if not ordered:
        return df
    keys = ([F.col("user_id")] if "user_id" in df.columns else []) + [F.col("date").desc()]
    if bounded and "user_id" not in df.columns:
        return df.coalesce(1).sortWithinPartitions(*keys)
    return df.orderBy(*keys)


def _require_range(start, end):
    if start is None or end is None:
        raise ValueError("per-user reports need calendar bounds (start, end)")


def _densify(cal_cols: DataFrame, per_day: DataFrame, start, end, by_user: bool,
             users: DataFrame | None) -> DataFrame:
    if by_user:
        _require_range(start, end)
        return daily.dense_by_user(cal_cols, per_day, users, start, end)
    return daily.dense_left(cal_cols, per_day, _bound(start, end))


def _users(df: DataFrame, user_id, users: DataFrame | None, start, end, tz: str, day_col: str | None) -> DataFrame:
    """Users a per-user report covers: all of the table, of the user dimension
    ``users``, or the one asked.

    Without ``users`` they are found by a scan of the facts' user column, over
    all days.  A user dimension (``sinks.users``: first and last UTC day of
    each user, kept by the loads) saves that scan; with its days, only users
    who had a fact by the report's last day are covered.
    """
    found = _user(df if users is None else users, user_id)
    if users is not None and "first_day" in users.columns and end is not None:
        hi = timez.local_range_millis(start, end, tz)[1]
        found = found.filter(F.col("first_day") <= _utc_day(F.lit(hi) if isinstance(hi, int) else hi))
    return found.select("user_id").distinct()


# ---- V1 ---------------------------------------------------------------------

def calendar_report(spark, start=calmod.DEFAULT_START, end=None, tz: str = TZ,
                    ordered: bool = True) -> DataFrame:
    return newest_first(calmod.calendar_days(spark, start, end, tz), ordered, bounded=True)


# ---- V2–V5: one metric of the points table per day ---------------------------

def points_by_day(points: DataFrame, data_type: str, tz: str, user_id, start, end,
                  day_col: str | None = None) -> DataFrame:
    """Filtered points with their local ``date`` (nanos rounded to ms)."""
    pts = _user(points.filter(F.col("dataTypeName") == F.lit(data_type)), user_id)
    pts = _prune(pts, "startTimeNanos", timez.NANOS_PER_MILLI, start, end, tz, day_col)
    date = timez.local_date(timez.millis_to_instant(timez.nanos_to_millis("startTimeNanos")), tz)
    out = pts.select("user_id", date.alias("date"), "value0_fpVal", "value0_intVal")
    return out.filter(_in_calendar(F.col("date"), start, end))


def daily_metric(points: DataFrame, cal: DataFrame, *, data_type: str, aggs: dict,
                 finish: dict, total: Column | None = None, tz: str = TZ, user_id=None, start=None, end=None,
                 day_col: str | None = None, ordered: bool = True,
                 by_user: bool = False, users: DataFrame | None = None) -> DataFrame:
    """Generic V2–V5: aggregate by local day, then densify on the calendar.

    ``aggs`` name → (count, sum, min or max; column) over the day's points;
    ``total`` is a float column whose sum ``s`` is exact, whatever the order of
    the rows; ``finish`` name → expression over the joined row (zero fill and
    rounding go here, after the join, so days without points see NULL
    aggregates as in SQL).  ``by_user`` gives one dense series per user of the
    table (of ``users``, where given) instead of one series over the selected
    users; rows without a user count as one user.
    """
    keys = ["user_id", "date"] if by_user else ["date"]
    facts = points_by_day(points, data_type, tz, user_id, start, end, day_col)
    if total is None:
        per_day = facts.groupBy(*keys).agg(*[getattr(F, how)(c).alias(n) for n, (how, c) in aggs.items()])
    else:
        per_day = exact.exact_sum_by(facts, keys, total, "s", aggs)
    joined = _densify(cal.select("date", "date_year_month"), per_day, start, end, by_user,
                      _users(points, user_id, users, start, end, tz, day_col) if by_user else None)
    out = joined.select(*keys, "date_year_month", *[e.alias(n) for n, e in finish.items()])
    return newest_first(out, ordered, _bound(start, end) is not None)


def _summed(value_scale: int | None) -> tuple[Column | None, dict]:
    """How to sum the float values: exactly, or in fixed point."""
    v = F.col("value0_fpVal")
    return (v, {}) if value_scale is None else (None, {"s": ("sum", daily.exact_values(v, value_scale))})


def daily_steps(points, cal, *, data_type=standins.STEP_TYPE, **kw) -> DataFrame:
    """V4: SUM of integer values, zero fill."""
    return daily_metric(points, cal, data_type=data_type,
                        aggs={"s": ("sum", F.col("value0_intVal"))},
                        finish={"step_count": F.coalesce(F.col("s"), F.lit(0)).cast("long")},
                        **kw)


def daily_distance(points, cal, *, data_type=standins.DISTANCE_TYPE,
                   value_scale: int | None = None, **kw) -> DataFrame:
    """V3: SUM of float values, zero fill, rounded to an integer."""
    total, aggs = _summed(value_scale)
    return daily_metric(points, cal, data_type=data_type, total=total, aggs=aggs,
                        finish={"distance": timez.round_long(F.coalesce(F.col("s"), F.lit(0)))},
                        **kw)


def daily_calories(points, cal, *, data_type=standins.CALORIES_TYPE,
                   value_scale: int | None = None, **kw) -> DataFrame:
    """V2: SUM of float values, NULL on days without points, rounded.
    (The output name keeps the warehouse view's spelling.)"""
    total, aggs = _summed(value_scale)
    return daily_metric(points, cal, data_type=data_type, total=total, aggs=aggs,
                        finish={"calrories": timez.round_long(F.col("s"))},
                        **kw)


def daily_heart_rate(points, cal, *, data_type=standins.HEART_RATE_TYPE,
                     value_scale: int | None = None, **kw) -> DataFrame:
    """V5: AVG/MIN/MAX per day, NULL on days without points, rounded."""
    total, aggs = _summed(value_scale)
    v = F.col("value0_fpVal")
    return daily_metric(
        points, cal, data_type=data_type, total=total,
        aggs={**aggs, "n": ("count", v), "lo": ("min", v), "hi": ("max", v)},
        finish={"avg_heart_rate": timez.round_long(F.col("s").cast("double") / F.col("n")),
                "min_heart_rate": timez.round_long(F.col("lo")),
                "max_heart_rate": timez.round_long(F.col("hi"))},
        **kw)


# ---- V6: sleep ----------------------------------------------------------------

def sleep_by_day_and_app(sessions: DataFrame, *, tz: str = TZ, user_id=None,
                         start=None, end=None, day_col: str | None = None,
                         sleep_types=tuple(labels.SLEEP_ACTIVITY_TYPES),
                         by_user: bool = False) -> DataFrame:
    """Distinct sleep pieces → local day of (start + 5 h) → ms per (day, app)
    (per (user, day, app) with ``by_user``)."""
    s = _user(sessions.filter(F.col("activityType").isin(*sleep_types)), user_id)
    if start is not None and end is not None:
        shift = SLEEP_SHIFT_HOURS * 3_600_000
        lo, hi = timez.local_range_millis(start, end, tz)
        lo, hi = (F.lit(x) if isinstance(x, int) else x for x in (lo, hi))
        s = s.filter(daily.in_range(F.col("startTimeMillis"), lo - F.lit(shift), hi - F.lit(shift)))
        if day_col:
            s = _prune(s, "startTimeMillis", 1, start, end, tz, day_col, pad_ms=shift)
    pieces = daily.dedup(s, ["user_id", "startTimeMillis", "endTimeMillis",
                             "application_packageName"])
    date = timez.local_date(timez.add_hours(timez.millis_to_instant("startTimeMillis"),
                                            SLEEP_SHIFT_HOURS), tz)
    pieces = pieces.select("user_id", date.alias("date"), "application_packageName",
                           (F.col("endTimeMillis") - F.col("startTimeMillis")).alias("ms"))
    keys = ["user_id", "date"] if by_user else ["date"]
    return pieces.filter(_in_calendar(F.col("date"), start, end)) \
        .groupBy(*keys, "application_packageName").agg(F.sum("ms").alias("ms"))


def daily_sleep(sessions: DataFrame, cal: DataFrame, *, tz: str = TZ, user_id=None,
                start=None, end=None, day_col: str | None = None,
                ordered: bool = True, by_user: bool = False,
                users: DataFrame | None = None) -> DataFrame:
    """V6: per day, the largest per-app total of sleep (seconds and hours)."""
    per_app = sleep_by_day_and_app(sessions, tz=tz, user_id=user_id, start=start,
                                   end=end, day_col=day_col, by_user=by_user)
    keys = ["user_id", "date"] if by_user else ["date"]
    per_day = per_app.groupBy(*keys).agg(
        F.max(F.col("ms").cast("double") / F.lit(1000)).alias("sleep_sec"),
        F.max(F.col("ms").cast("double") / F.lit(3_600_000)).alias("sleep_hour"))
    out = _densify(cal.select("date", "date_year_month"), per_day, start, end, by_user,
                   _users(sessions, user_id, users, start, end, tz, day_col) if by_user else None)
    return newest_first(out.select(*keys, "date_year_month", "sleep_sec", "sleep_hour"),
                        ordered, _bound(start, end) is not None)


# ---- V7/V8: tracked time ---------------------------------------------------------

def productive_facts(activities: DataFrame, *, tz: str = TZ, user_id=None,
                     start=None, end=None, day_col: str | None = None) -> DataFrame:
    """Productive activities with local ts/date computed once."""
    a = _user(activities.filter(labels.is_productive("productivity_string")), user_id)
    a = _prune(a, "date_timestamp_millis", 1, start, end, tz, day_col)
    lts = timez.local_ts(timez.millis_to_instant("date_timestamp_millis"), tz)
    a = a.withColumn("local_ts", lts).withColumn("date", F.to_date("local_ts"))
    return a.filter(_in_calendar(F.col("date"), start, end))


WORKING = (tuple(labels.WORKING_DAYS), labels.WORKING_FIRST_HOUR, labels.WORKING_LAST_HOUR)


def daily_productive(activities: DataFrame, cal: DataFrame, *, tz: str = TZ,
                     user_id=None, start=None, end=None, day_col: str | None = None,
                     ordered: bool = True, by_user: bool = False,
                     working=WORKING, users: DataFrame | None = None) -> DataFrame:
    """V7: productive seconds inside / outside working hours and in total.

    One scan with complementary conditional sums replaces two scans and two
    joins; rows whose condition is NULL have no date and never join anyway.
    """
    a = productive_facts(activities, tz=tz, user_id=user_id, start=start, end=end,
                         day_col=day_col)
    inside, outside = daily.split_sum(F.col("time_spent_seconds"),
                                      labels.is_working_time("local_ts", *working))
    keys = ["user_id", "date"] if by_user else ["date"]
    per_day = a.groupBy(*keys).agg(inside.alias("w"), outside.alias("o"))
    j = _densify(cal.select("date", "date_year_month", "dayofweek"), per_day, start, end,
                 by_user, _users(activities, user_id, users, start, end, tz, day_col) if by_user else None)
    w = F.coalesce(F.col("w"), F.lit(0)).cast("long")
    o = F.coalesce(F.col("o"), F.lit(0)).cast("long")
    out = j.select(*keys, "date_year_month", w.alias("working_time_sec"),
                   o.alias("outside_working_time_sec"), (w + o).alias("total_time_sec"),
                   "dayofweek")
    return newest_first(out, ordered, _bound(start, end) is not None)


def daily_productive_two_joins(activities: DataFrame, cal: DataFrame, *, tz: str = TZ,
                               user_id=None, start=None, end=None,
                               working=WORKING) -> DataFrame:
    """V7 in its original shape (J3): calendar LEFT JOIN inside-hours sums
    LEFT JOIN outside-hours sums, each from its own scan.  Kept as the
    reference form the one-scan ``daily_productive`` is tested against."""
    a = productive_facts(activities, tz=tz, user_id=user_id, start=start, end=end)
    cond = labels.is_working_time("local_ts", *working)
    inside = a.filter(cond).groupBy("date").agg(F.sum("time_spent_seconds").alias("w"))
    outside = a.filter(~cond).groupBy("date").agg(F.sum("time_spent_seconds").alias("o"))
    bound = _bound(start, end)
    j = daily.dense_left(cal.select("date", "date_year_month", "dayofweek"), inside, bound)
    j = daily.dense_left(j, outside, bound)
    w = F.coalesce(F.col("w"), F.lit(0)).cast("long")
    o = F.coalesce(F.col("o"), F.lit(0)).cast("long")
    return j.select("date", "date_year_month", w.alias("working_time_sec"),
                    o.alias("outside_working_time_sec"), (w + o).alias("total_time_sec"),
                    "dayofweek")


DETAIL_KEYS = ["category", "productivity", "productivity_string", "activity",
               "working_hours", "date_hour"]


def daily_productive_details(activities: DataFrame, cal: DataFrame, *, tz: str = TZ,
                             user_id=None, start=None, end=None,
                             day_col: str | None = None,
                             ordered: bool = True, by_user: bool = False,
                             working=WORKING, materialize: bool = False,
                             users: DataFrame | None = None) -> DataFrame:
    """V8: seconds per day × category × productivity × activity × hour.

    Days without facts give one row of NULL facts (per user with ``by_user``).
    Those days come from a count over the grouped facts.  With ``materialize``
    the grouped facts are checkpointed once into the shared checkpoint folder
    and both branches read them.
    """
    a = productive_facts(activities, tz=tz, user_id=user_id, start=start, end=end,
                         day_col=day_col)
    a = a.select("user_id", "date", "category", "productivity", "productivity_string",
                 "activity",
                 labels.working_hours_label("local_ts", *working).alias("working_hours"),
                 F.hour("local_ts").cast("long").alias("date_hour"),
                 "time_spent_seconds")
    keys = ["user_id", "date"] if by_user else ["date"]
    detail = a.groupBy(*keys, *DETAIL_KEYS).agg(
        F.sum("time_spent_seconds").alias("time_sec"))
    if materialize:
        detail = checkpointed(detail)
    cal_cols = cal.select("date", "date_year_month", "dayofweek")
    if by_user:
        _require_range(start, end)
        if users is not None:
            asked = _users(activities, user_id, users, start, end, tz, day_col).withColumnRenamed("user_id", "__user")
            detail = detail.join(asked, F.col("user_id").eqNullSafe(F.col("__user")), "left_semi")
        j = daily.dense_detail_by_user(cal_cols, detail, _users(activities, user_id, users, start, end, tz, day_col),
                                       start, end)
    else:
        j = daily.dense_left_detail(cal_cols, detail, _bound(start, end))
    out = j.select(*keys[:-1], "date", "date_year_month", "category", "productivity",
                   "productivity_string", "activity", "time_sec", "working_hours",
                   "date_hour", "dayofweek")
    return newest_first(out, ordered, bounded=False)


# ---- S11: 30-minute buckets of points ------------------------------------------

BUCKET_MS = 1_800_000


def bucket_points(points: DataFrame, *, step_ms: int = BUCKET_MS, origin_ms: int = 0,
                  value_scale: int | None = None) -> DataFrame:
    """Points summed per (user, data type, step-long bucket of the start time)."""
    ms = timez.nanos_to_millis("startTimeNanos")
    b = F.floor((ms - F.lit(origin_ms)) / F.lit(step_ms)).cast("long")
    keys = ["user_id", "dataTypeName", "bucket"]
    rows = points.select("user_id", "dataTypeName", b.alias("bucket"), "value0_fpVal", "value0_intVal")
    others = {"value0_intVal": ("sum", F.col("value0_intVal")), "n_points": ("count", F.lit(1))}
    if value_scale is None:
        g = exact.exact_sum_by(rows, keys, F.col("value0_fpVal"), "fp", others)
    else:
        fp = daily.exact_values(F.col("value0_fpVal"), value_scale)
        g = rows.groupBy(*keys).agg(F.sum(fp).alias("fp"), *[getattr(F, how)(c).alias(n) for n, (how, c) in others.items()])
    start = F.col("bucket") * F.lit(step_ms) + F.lit(origin_ms)
    return g.select("user_id", "dataTypeName", start.alias("startTimeMillis"),
                    (start + F.lit(step_ms)).alias("endTimeMillis"),
                    F.col("fp").cast("double").alias("value0_fpVal"),
                    "value0_intVal", "n_points")
