"""Time helpers (all built-in Catalyst expressions, no UDFs).

Facts store time as epoch integers: nanoseconds for fitness points,
milliseconds for sessions and tracked activities.  With the session time zone
pinned to UTC a ``TIMESTAMP`` is an instant; ``from_utc_timestamp`` turns it
into the wall-clock time of a zone (DST aware), from which the local date,
hour and weekday are read.
"""

from __future__ import annotations

import datetime as _dt
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F

NANOS_PER_MILLI = 1_000_000
MILLIS_PER_DAY = 86_400_000


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _tz(tz) -> Column:
    return F.lit(tz) if isinstance(tz, str) else tz


def round_long(x) -> Column:
    """Float → integer, rounding half away from zero (the warehouse rule).

    A bare ``cast`` truncates (2.5 → 2); ``round`` first gives 3.
    """
    return F.round(_c(x)).cast("long")


def nanos_to_millis(nanos) -> Column:
    """Epoch ns → epoch ms as ``round(ns / 1e6)`` (float division, rounded)."""
    return round_long(_c(nanos) / F.lit(NANOS_PER_MILLI))


def ntz_to_instant(ts) -> Column:
    """TIMESTAMP_NTZ holding UTC wall time → TIMESTAMP (session zone UTC)."""
    return _c(ts).cast("timestamp")


def instant_millis(ts) -> Column:
    """TIMESTAMP → epoch ms, floored (sub-millisecond digits dropped)."""
    return F.unix_millis(_c(ts))


def millis_to_instant(ms) -> Column:
    return F.timestamp_millis(_c(ms))


def local_ts(instant, tz="Asia/Seoul") -> Column:
    """Wall-clock time of ``instant`` in zone ``tz`` (a name or a column)."""
    return F.from_utc_timestamp(_c(instant), _tz(tz))


def local_date(instant, tz="Asia/Seoul") -> Column:
    return F.to_date(local_ts(instant, tz))


def local_hour(instant, tz="Asia/Seoul") -> Column:
    return F.hour(local_ts(instant, tz)).cast("long")


def sunday_week(d) -> Column:
    """Week number 0..53, weeks starting on Sunday; days before the first
    Sunday of the year are week 0 (as ``strftime('%U')``)."""
    d = _c(d)
    return F.floor((F.dayofyear(d) + F.lit(7) - F.dayofweek(d)) / F.lit(7)).cast("long")


def iso_year(d) -> Column:
    return F.extract(F.lit("YEAROFWEEK"), _c(d)).cast("long")


def iso_week(d) -> Column:
    return F.weekofyear(_c(d)).cast("long")


def day_of_week(d) -> Column:
    """1 = Sunday … 7 = Saturday."""
    return F.dayofweek(_c(d)).cast("long")


def current_local_date(tz="Asia/Seoul") -> Column:
    return F.to_date(F.from_utc_timestamp(F.current_timestamp(), _tz(tz)))


def add_hours(instant, hours: int) -> Column:
    return _c(instant) + F.make_interval(hours=F.lit(hours))


def parse_rfc3339_millis(s) -> Column:
    """RFC 3339 text (``…T23:59:59.99Z``, ``+09:00``) → epoch ms; bad text → NULL."""
    return F.unix_millis(F.try_to_timestamp(_c(s)))


def parse_local_millis(s, tz, fmt: str = "yyyy-MM-dd'T'HH:mm:ss") -> Column:
    """Civil time text in zone ``tz`` → epoch ms; unparsable → NULL."""
    civil = F.try_to_timestamp(_c(s), F.lit(fmt))
    return F.unix_millis(F.to_utc_timestamp(civil, _tz(tz)))


# ---- driver-side helpers for literal bounds (plan-time pruning) -----------

def to_date_value(d) -> _dt.date:
    if isinstance(d, _dt.datetime):
        return d.date()
    if isinstance(d, _dt.date):
        return d
    return _dt.date.fromisoformat(str(d))


def local_day_start_millis(day, tz: str) -> int:
    """Epoch ms of 00:00 of local ``day`` in zone ``tz`` (exact, DST aware)."""
    d = to_date_value(day)
    start = _dt.datetime(d.year, d.month, d.day, tzinfo=ZoneInfo(tz))
    return int(start.timestamp() * 1000)


def local_range_millis(first_day, last_day, tz: str) -> tuple:
    """Half-open UTC epoch-ms range covering local days first..last in ``tz``;
    a bound of a date expression is an expression."""
    if isinstance(last_day, Column):
        hi = _day_start(F.date_add(last_day, 1), tz)
    else:
        hi = local_day_start_millis(to_date_value(last_day) + _dt.timedelta(days=1), tz)
    lo = _day_start(first_day, tz) if isinstance(first_day, Column) else local_day_start_millis(first_day, tz)
    return lo, hi


def _day_start(day: Column, tz: str) -> Column:
    return F.unix_millis(F.to_utc_timestamp(day.cast("timestamp"), tz))
