"""Calendar dimension: one row per local day, with the usual date parts."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daycut.functions import timez

DEFAULT_START = "2018-07-01"
DEFAULT_TZ = "Asia/Seoul"

CALENDAR_COLUMNS = ["date", "date_year_month", "isoyear", "isoweek", "year",
                    "month", "week", "dayofweek", "quarter", "timezone"]


def date_col(d) -> Column:
    """A date, its text or a date expression as a Column."""
    if isinstance(d, Column):
        return d.cast("date")
    return F.lit(timez.to_date_value(d))


def with_date_parts(days: DataFrame, tz: str) -> DataFrame:
    d = F.col("date")
    return days.select(
        d.alias("date"),
        F.date_format(d, "yyyy-MM").alias("date_year_month"),
        timez.iso_year(d).alias("isoyear"),
        timez.iso_week(d).alias("isoweek"),
        F.year(d).cast("long").alias("year"),
        F.month(d).cast("long").alias("month"),
        timez.sunday_week(d).alias("week"),
        timez.day_of_week(d).alias("dayofweek"),
        F.quarter(d).cast("long").alias("quarter"),
        F.lit(tz).alias("timezone"),
    )


def yesterday(tz: str = DEFAULT_TZ, now: Column | None = None) -> Column:
    """The last whole local day in ``tz``.  A query folds it to a literal when
    it runs, so a view over it moves with the date and still prunes."""
    now = F.current_timestamp() if now is None else now
    return F.date_sub(F.to_date(F.from_utc_timestamp(now, tz)), 1)


def calendar_days(spark: SparkSession, start=DEFAULT_START, end=None,
                  tz: str = DEFAULT_TZ) -> DataFrame:
    """Dense local days ``start..end`` (inclusive); ``end`` defaults to
    yesterday in ``tz``.  An empty range gives no rows (a plain date
    ``sequence`` would count backwards instead)."""
    s = date_col(start)
    e = yesterday(tz) if end is None else date_col(end)
    days = spark.range(1).select(
        F.explode(F.when(s <= e, F.sequence(s, e))).alias("date"))
    return with_date_parts(days, tz)


def calendar_over(df: DataFrame, date_col: str, tz: str = DEFAULT_TZ,
                  pad_days: int = 0) -> DataFrame:
    """Calendar spanning the local dates found in ``df`` (lazy: one global
    min/max aggregate, then a generator)."""
    bounds = df.agg(F.min(date_col).alias("lo"), F.max(date_col).alias("hi"))
    lo = F.date_sub(F.col("lo"), pad_days)
    hi = F.date_add(F.col("hi"), pad_days)
    days = bounds.select(F.explode(F.when(lo <= hi, F.sequence(lo, hi))).alias("date"))
    return with_date_parts(days, tz)


def day_count(start, end) -> int | None:
    """Rows a literal calendar will have (used as a proven broadcast bound);
    None if a bound is an expression."""
    if isinstance(start, Column) or isinstance(end, Column):
        return None
    s, e = timez.to_date_value(start), timez.to_date_value(end)
    return max(0, (e - s).days + 1)


def is_literal_range(start, end) -> bool:
    ok = (str, _dt.date)
    return isinstance(start, ok) and isinstance(end, ok)
