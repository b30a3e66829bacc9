"""Registered queries over the driver's test tables, and their DuckDB oracles.

Every query reads the whole ``events`` table (through the row-wise stand-ins
of ``standins``) so its work grows with the table.  The oracle SQL is written
in the shape of the original warehouse views (calendar LEFT JOIN raw facts,
then GROUP BY), so it also checks the rewrites done on the Spark side
(aggregate-before-join, one scan instead of two, dropped inner calendar).
"""

from __future__ import annotations

import functools

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daycut.functions import timez
from daycut.operators import intervals
from daycut.plans import reports, standins
from daycut.session import apply_conf
from daycut.sources import calendar as calmod

# ---- fixed parameters of the registered queries -----------------------------
TZ = "Asia/Seoul"
TZ_OFFSET_SQL = "INTERVAL 9 HOUR"      # Seoul has no DST: a fixed offset in SQL
DAY_MS = 86_400_000
VALUE_SCALE = 2                        # events.value has two decimals
# -----------------------------------------------------------------------------


def _prep(spark: SparkSession, sf_dir: str) -> DataFrame:
    apply_conf(spark)
    return standins.read_events(spark, sf_dir)


@functools.lru_cache(maxsize=16)
def _span(spark: SparkSession, sf_dir: str):
    """First and last local day of the events, and the UTC days they span as
    a half-open range of epoch milliseconds."""
    ts = timez.ntz_to_instant("ts")
    lo, hi, first, last = _prep(spark, sf_dir).agg(
        F.min(timez.local_date(ts, TZ)), F.max(timez.local_date(ts, TZ)),
        F.min(F.unix_millis(F.date_trunc("day", ts))), F.max(F.unix_millis(F.date_trunc("day", ts)))).first()
    if lo is None:                         # no events: an empty day range
        return "1970-01-01", "1970-01-01", 0, DAY_MS
    return str(lo), str(hi), first, last + DAY_MS


def _range(spark: SparkSession, sf_dir: str) -> dict:
    start, end, _, _ = _span(spark, sf_dir)
    return dict(tz=TZ, start=start, end=end)


def _cal(spark: SparkSession, sf_dir: str) -> DataFrame:
    start, end, _, _ = _span(spark, sf_dir)
    return calmod.calendar_days(spark, start, end, TZ)


def q_calendar_days(spark, sf_dir):
    """V1 over the local days the events span (the run date's 'yesterday')."""
    ev = _prep(spark, sf_dir)
    dates = ev.select(timez.local_date(timez.ntz_to_instant("ts"), TZ).alias("date"))
    return reports.newest_first(calmod.calendar_over(dates, "date", TZ), True)


def q_daily_steps(spark, sf_dir):
    pts = standins.points_from_events(_prep(spark, sf_dir))
    return reports.daily_steps(pts, _cal(spark, sf_dir), **_range(spark, sf_dir))


def q_daily_distance(spark, sf_dir):
    pts = standins.points_from_events(_prep(spark, sf_dir))
    return reports.daily_distance(pts, _cal(spark, sf_dir), **_range(spark, sf_dir))


def q_daily_calories(spark, sf_dir):
    pts = standins.points_from_events(_prep(spark, sf_dir))
    return reports.daily_calories(pts, _cal(spark, sf_dir), **_range(spark, sf_dir))


def q_daily_heart_rate(spark, sf_dir):
    pts = standins.points_from_events(_prep(spark, sf_dir))
    return reports.daily_heart_rate(pts, _cal(spark, sf_dir), **_range(spark, sf_dir))


def loaded_sessions(spark, sf_dir) -> DataFrame:
    """Sessions as the load job stores them: clipped to the window, split."""
    s = standins.sessions_from_events(_prep(spark, sf_dir))
    s = intervals.clip_intervals(s, "startTimeMillis", "endTimeMillis",
                                 *_span(spark, sf_dir)[2:])
    return intervals.split_intervals(s, "startTimeMillis", "endTimeMillis")


def q_daily_sleep(spark, sf_dir):
    return reports.daily_sleep(loaded_sessions(spark, sf_dir), _cal(spark, sf_dir), **_range(spark, sf_dir))


def q_daily_productive(spark, sf_dir):
    acts = standins.activities_from_events(_prep(spark, sf_dir))
    return reports.daily_productive(acts, _cal(spark, sf_dir), **_range(spark, sf_dir))


def q_daily_productive_details(spark, sf_dir):
    acts = standins.activities_from_events(_prep(spark, sf_dir))
    return reports.daily_productive_details(acts, _cal(spark, sf_dir), **_range(spark, sf_dir))


def q_daily_steps_by_user(spark, sf_dir):
    """V4 for every user of the table: one dense series per user."""
    pts = standins.points_from_events(_prep(spark, sf_dir))
    return reports.daily_steps(pts, _cal(spark, sf_dir), by_user=True, **_range(spark, sf_dir))


def q_daily_sleep_by_user(spark, sf_dir):
    """V6 for every user of the sessions table."""
    return reports.daily_sleep(loaded_sessions(spark, sf_dir), _cal(spark, sf_dir), by_user=True,
                               **_range(spark, sf_dir))


def q_daily_productive_by_user(spark, sf_dir):
    """V7 for every user of the time-tracking table."""
    acts = standins.activities_from_events(_prep(spark, sf_dir))
    return reports.daily_productive(acts, _cal(spark, sf_dir), by_user=True, **_range(spark, sf_dir))


def q_daily_productive_details_by_user(spark, sf_dir):
    """V8 for every user of the time-tracking table."""
    acts = standins.activities_from_events(_prep(spark, sf_dir))
    return reports.daily_productive_details(acts, _cal(spark, sf_dir), by_user=True, **_range(spark, sf_dir))


def q_bucket_points_30m(spark, sf_dir):
    pts = standins.points_from_events(_prep(spark, sf_dir))
    return reports.bucket_points(pts, value_scale=VALUE_SCALE)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "calendar_days": q_calendar_days,
    "daily_calories": q_daily_calories,
    "daily_distance": q_daily_distance,
    "daily_steps": q_daily_steps,
    "daily_heart_rate": q_daily_heart_rate,
    "daily_sleep": q_daily_sleep,
    "daily_productive": q_daily_productive,
    "daily_productive_details": q_daily_productive_details,
    "bucket_points_30m": q_bucket_points_30m,
    "daily_steps_by_user": q_daily_steps_by_user,
    "daily_sleep_by_user": q_daily_sleep_by_user,
    "daily_productive_by_user": q_daily_productive_by_user,
    "daily_productive_details_by_user": q_daily_productive_details_by_user,
}


# ---- oracle SQL (DuckDB; events is a registered view) -------------------------

def _cal_sql(lo: str, hi: str) -> str:
    return f"""cal AS (
  SELECT date,
         strftime(date, '%Y-%m') AS date_year_month,
         CAST(extract(isoyear FROM date) AS BIGINT) AS isoyear,
         CAST(extract(week FROM date) AS BIGINT) AS isoweek,
         CAST(extract(year FROM date) AS BIGINT) AS year,
         CAST(extract(month FROM date) AS BIGINT) AS month,
         CAST(strftime(date, '%U') AS BIGINT) AS week,
         CAST(extract(dow FROM date) + 1 AS BIGINT) AS dayofweek,
         CAST(extract(quarter FROM date) AS BIGINT) AS quarter,
         '{TZ}' AS timezone
  FROM (SELECT CAST(d AS DATE) AS date
        FROM generate_series({lo}, {hi}, INTERVAL 1 DAY) AS t(d)))"""


def _ms_date(ms: str) -> str:
    return f"CAST(epoch_ms({ms}) + {TZ_OFFSET_SQL} AS DATE)"


def _ms_hour(ms: str) -> str:
    return f"hour(epoch_ms({ms}) + {TZ_OFFSET_SQL})"


FIRST_DAY = f"(SELECT min(CAST(ts + {TZ_OFFSET_SQL} AS DATE)) FROM events)"
LAST_DAY = f"(SELECT max(CAST(ts + {TZ_OFFSET_SQL} AS DATE)) FROM events)"
WINDOW_LO = "(SELECT epoch_ms(date_trunc('day', min(ts))) FROM events)"
WINDOW_HI = f"(SELECT epoch_ms(date_trunc('day', max(ts))) + {DAY_MS} FROM events)"


def _dense_sql(sources: str, totals: str, empty: dict[str, str], weekday: bool = False, users: str | None = None) -> str:
    """Totals of the days that have any (``totals``: ``date`` and one column
    for each of ``empty``), and the rest of the span's days with what an empty
    day shows; for every user of the relation ``users``, if given."""
    day = "strftime(date, '%Y-%m') AS date_year_month" + (
        ", CAST(extract(dow FROM date) + 1 AS BIGINT) AS dayofweek" if weekday else "")
    key = "user_id, date" if users else "date"
    every = f", (SELECT DISTINCT user_id FROM {users})" if users else ""
    return f"""WITH {sources},
totals AS ({totals}),
days AS (SELECT CAST(unnest(generate_series({FIRST_DAY}, {LAST_DAY}, INTERVAL 1 DAY)) AS DATE) AS date)
SELECT {key}, {day}, {', '.join(empty)} FROM totals WHERE date BETWEEN {FIRST_DAY} AND {LAST_DAY}
UNION ALL BY NAME
SELECT {key}, {day}, {', '.join(f'{v} AS {c}' for c, v in empty.items())}
FROM (SELECT * FROM days{every}) ANTI JOIN totals USING ({key})"""


def _points_sql(data_type: str, empty: dict[str, str], by_user: bool = False, **measures: str) -> str:
    """Measures over the points of a type, per local day of their start."""
    day = _ms_date("CAST(round(startTimeNanos / 1000000) AS BIGINT)")
    listed = ", ".join(f"{sql} AS {name}" for name, sql in measures.items())
    who = "user_id, " if by_user else ""
    return _dense_sql(f"p AS ({standins.ORACLE_POINTS})",
                      f"SELECT {who}{day} AS date, {listed} FROM p WHERE dataTypeName = '{data_type}' GROUP BY ALL",
                      {name: empty.get(name, "NULL") for name in measures}, users="p" if by_user else None)


def _sleep_sql(who: str = "") -> str:
    """Distinct pieces of sleep, summed per app and the day five hours later;
    the app with most counts."""
    return _dense_sql(LOADED_SESSIONS_SQL, f"""
  SELECT {who}date, CAST(max(ms) AS DOUBLE) / 1000 AS sleep_sec, CAST(max(ms) AS DOUBLE) / 3600000 AS sleep_hour
  FROM (SELECT {who}{_ms_date('startTimeMillis + 5 * 3600000')} AS date, application_packageName,
               sum(endTimeMillis - startTimeMillis) AS ms
        FROM (SELECT DISTINCT user_id, startTimeMillis, endTimeMillis, application_packageName
              FROM sessions WHERE activityType IN (72, 109, 111)) GROUP BY ALL) GROUP BY ALL""",
                      {"sleep_sec": "NULL", "sleep_hour": "NULL"}, users="sessions" if who else None)


def _productive_sql(who: str = "") -> str:
    return _dense_sql(PRODUCTIVE_SQL, f"""
  SELECT {who}date, CAST(coalesce(sum(time_spent_seconds) FILTER (working), 0) AS BIGINT) AS working_time_sec,
         CAST(coalesce(sum(time_spent_seconds) FILTER (NOT working), 0) AS BIGINT) AS outside_working_time_sec,
         CAST(coalesce(sum(time_spent_seconds), 0) AS BIGINT) AS total_time_sec
  FROM work GROUP BY ALL""", dict.fromkeys(("working_time_sec", "outside_working_time_sec", "total_time_sec"), "0"),
                      True, "a" if who else None)


def _details_sql(who: str = "") -> str:
    return _dense_sql(PRODUCTIVE_SQL, f"""
  SELECT {who}date, category, productivity, productivity_string, activity, CAST(hour AS BIGINT) AS date_hour,
         CASE WHEN working THEN 'Working hours' ELSE 'Outside working hours' END AS working_hours,
         CAST(sum(time_spent_seconds) AS BIGINT) AS time_sec
  FROM work GROUP BY ALL""", dict.fromkeys(("category", "productivity", "productivity_string", "activity", "time_sec",
                                            "working_hours", "date_hour"), "NULL"), True, "a" if who else None)


# the exact sum of the doubles, which are whole numbers of 2^-60 here, rounded once
EXACT_SUM = f"(CAST(sum(CAST(value0_fpVal * {2 ** 60} AS HUGEINT)) AS DOUBLE) / {2 ** 60})"

LOADED_SESSIONS_SQL = f"""s AS ({standins.ORACLE_SESSIONS}),
clipped AS (
  SELECT * REPLACE (greatest(startTimeMillis, {WINDOW_LO}) AS startTimeMillis,
                    least(endTimeMillis, {WINDOW_HI}) AS endTimeMillis)
  FROM s),
sessions AS (
  SELECT * EXCLUDE (p, endTimeMillis) REPLACE (p AS startTimeMillis),
         least(p + 1800000, endTimeMillis) AS endTimeMillis
  FROM (SELECT *, unnest(generate_series(startTimeMillis, endTimeMillis, 1800000)) AS p
        FROM clipped WHERE endTimeMillis - startTimeMillis > 1800000)
  UNION ALL BY NAME
  SELECT * FROM clipped WHERE NOT (endTimeMillis - startTimeMillis > 1800000))"""

# tracked productive time with its local day and whether it lies in working hours
PRODUCTIVE_SQL = f"""a AS ({standins.ORACLE_ACTIVITIES}),
work AS (SELECT *, day AS date, isodow(day) <= 5 AND hour BETWEEN 9 AND 19 AS working
         FROM (SELECT *, {_ms_date('date_timestamp_millis')} AS day, {_ms_hour('date_timestamp_millis')} AS hour
               FROM a WHERE contains(productivity_string, 'productive')))"""

ORACLE: dict[str, str] = {
    "calendar_days": f"""WITH b AS (
  SELECT min(CAST(ts + {TZ_OFFSET_SQL} AS DATE)) AS lo,
         max(CAST(ts + {TZ_OFFSET_SQL} AS DATE)) AS hi FROM events),
{_cal_sql("(SELECT lo FROM b)", "(SELECT hi FROM b)")}
SELECT * FROM cal ORDER BY date DESC""",

    "daily_calories": _points_sql(standins.CALORIES_TYPE, {}, calrories=f"CAST(round({EXACT_SUM}) AS BIGINT)"),
    "daily_distance": _points_sql(standins.DISTANCE_TYPE, {"distance": "0"},
                                  distance=f"CAST(round(coalesce({EXACT_SUM}, 0)) AS BIGINT)"),
    "daily_steps": _points_sql(standins.STEP_TYPE, {"step_count": "0"},
                               step_count="CAST(coalesce(sum(value0_intVal), 0) AS BIGINT)"),
    "daily_heart_rate": _points_sql(
        standins.HEART_RATE_TYPE, {},
        avg_heart_rate=f"CAST(round({EXACT_SUM} / count(value0_fpVal)) AS BIGINT)",
        min_heart_rate="CAST(round(min(value0_fpVal)) AS BIGINT)", max_heart_rate="CAST(round(max(value0_fpVal)) AS BIGINT)"),

    "daily_sleep": _sleep_sql(),
    "daily_productive": _productive_sql(),
    "daily_productive_details": _details_sql(),

    "bucket_points_30m": f"""WITH p AS ({standins.ORACLE_POINTS})
SELECT user_id, dataTypeName, bucket * 1800000 AS startTimeMillis,
       bucket * 1800000 + 1800000 AS endTimeMillis,
       CAST(SUM(CAST(value0_fpVal AS DECIMAL(18,{VALUE_SCALE}))) AS DOUBLE) AS value0_fpVal,
       CAST(SUM(value0_intVal) AS BIGINT) AS value0_intVal,
       COUNT(*) AS n_points
FROM (SELECT *, CAST(floor(round(startTimeNanos / 1000000) / 1800000) AS BIGINT) AS bucket
      FROM p)
GROUP BY user_id, dataTypeName, bucket""",
}

# ---- per-user forms: every user of the table × every calendar day -------------------

ORACLE |= {
    "daily_steps_by_user": _points_sql(standins.STEP_TYPE, {"step_count": "0"}, True,
                                       step_count="CAST(coalesce(sum(value0_intVal), 0) AS BIGINT)"),
    "daily_sleep_by_user": _sleep_sql("user_id, "),
    "daily_productive_by_user": _productive_sql("user_id, "),
    "daily_productive_details_by_user": _details_sql("user_id, "),
}
