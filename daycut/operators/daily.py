"""Building blocks of the calendar-dense daily reports.

Every report is "calendar LEFT JOIN facts, GROUP BY day".  The calendar's
``date`` is unique, so facts are aggregated by day (or by the report's group
keys) *before* the join: the aggregate runs with map-side partial combine, the
shuffle carries at most one row per (map task, group), and a hot day costs no
more than any other.  What is broadcast is bounded by the calendar length,
which is known on the driver whenever the calendar has literal bounds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daycut.sources.calendar import date_col, day_count

# Conservative per-row size estimate for day-grain rows (date + a few longs).
DAY_ROW_BYTES = 96
DEFAULT_BROADCAST_BYTES = 10 * 1024 * 1024


def broadcast_limit_bytes(df: DataFrame) -> int:
    raw = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold", None)
    if raw is None:
        return DEFAULT_BROADCAST_BYTES
    raw = str(raw).strip().lower()
    mult = 1
    for suf, m in (("kb", 1 << 10), ("mb", 1 << 20), ("gb", 1 << 30), ("tb", 1 << 40), ("k", 1 << 10),
                   ("m", 1 << 20), ("g", 1 << 30), ("t", 1 << 40), ("b", 1)):
        if raw.endswith(suf):
            raw, mult = raw[: -len(suf)], m
            break
    try:
        return int(float(raw) * mult)
    except ValueError:
        return DEFAULT_BROADCAST_BYTES


def bounded_broadcast(df: DataFrame, bound_rows: int | None,
                      row_bytes: int = DAY_ROW_BYTES) -> DataFrame:
    """Hint a broadcast only when a proven row bound fits the threshold.

    Without a bound (or above it) the plain frame is returned, and the join
    falls back to a shuffle join that AQE may still turn into a broadcast
    once the real size is known.
    """
    if bound_rows is None:
        return df
    limit = broadcast_limit_bytes(df)
    if limit <= 0 or bound_rows * row_bytes > limit:
        return df
    return F.broadcast(df)


def dense_left(cal: DataFrame, per_day: DataFrame, bound_rows: int | None,
               on: str = "date") -> DataFrame:
    """calendar LEFT JOIN per-day facts (``per_day`` has one row per date and
    was restricted to the calendar's range, so it is no larger than it)."""
    return cal.join(bounded_broadcast(per_day, bound_rows), on=on, how="left")


def dense_left_detail(cal: DataFrame, detail: DataFrame, bound_rows: int | None,
                      on: str = "date") -> DataFrame:
    """calendar LEFT JOIN facts with many rows per date.

    Written as (facts ⋈ calendar) ∪ (calendar ▷ fact dates): the calendar is
    the bounded side and is broadcast to the facts, instead of shuffling the
    growing fact side to meet a tiny calendar.  The days without facts are
    those that a count by day lacks: a count over all of ``detail`` keeps its
    plan as it is, so both branches share one scan and its exchange, and has
    one row a day, again bounded by the calendar.
    """
    cal_b = bounded_broadcast(cal, bound_rows)
    matched = detail.join(cal_b, on=on, how="inner")
    missing = [c for c in detail.columns if c != on]
    per_day = detail.groupBy(on).agg(F.count(F.col(missing[-1])).alias("__n"))
    empty_days = cal.join(bounded_broadcast(per_day, bound_rows), on=on, how="left") \
        .filter(F.col("__n").isNull()).drop("__n")
    for c in missing:
        empty_days = empty_days.withColumn(c, F.lit(None).cast(detail.schema[c].dataType))
    return matched.unionByName(empty_days)


def dense_by_user(cal: DataFrame, facts: DataFrame, users: DataFrame, start, end,
                  on: str = "date", user: str = "user_id") -> DataFrame:
    """Every (user, calendar day) LEFT JOIN facts keyed by (user, day).

    The grid is generated per user with a day ``sequence`` (no cross join);
    the calendar's date parts come from a broadcast of the bounded calendar;
    facts are unique per (user, day), so the final join is a plain shuffle
    join on two unique keys with nothing to skew.
    """
    s, e = date_col(start), date_col(end)
    grid = users.select(user, F.explode(F.when(s <= e, F.sequence(s, e))).alias(on))
    grid = grid.join(bounded_broadcast(cal, day_count(start, end)), on=on, how="inner")
    return _match(grid, facts, user, on, "left").drop("__user", "__on")


def _match(grid: DataFrame, facts: DataFrame, user: str, on: str, how: str) -> DataFrame:
    """Join on (user, day) that takes rows without a user as one user's."""
    facts = facts.withColumnsRenamed({user: "__user", on: "__on"})
    return grid.join(facts, F.col(user).eqNullSafe(F.col("__user")) & (F.col(on) == F.col("__on")), how)


def dense_detail_by_user(cal: DataFrame, detail: DataFrame, users: DataFrame, start, end,
                         on: str = "date", user: str = "user_id") -> DataFrame:
    """Per-user form of ``dense_left_detail``: (facts ⋈ broadcast calendar) ∪
    ((user, day) grid ▷ (user, day) pairs that have facts).  The anti join is
    a shuffle join on (user, day), unique on its right side."""
    bound = day_count(start, end)
    matched = detail.join(bounded_broadcast(cal, bound), on=on, how="inner")
    s, e = date_col(start), date_col(end)
    grid = users.select(user, F.explode(F.when(s <= e, F.sequence(s, e))).alias(on))
    grid = grid.join(bounded_broadcast(cal, bound), on=on, how="inner")
    empty = _match(grid, detail.select(user, on).distinct(), user, on, "left_anti")
    for c in detail.columns:
        if c not in (user, on):
            empty = empty.withColumn(c, F.lit(None).cast(detail.schema[c].dataType))
    return matched.unionByName(empty)


def in_range(col: Column, lo, hi) -> Column:
    """Half-open ``lo <= col < hi`` (either bound may be None)."""
    cond = F.lit(True)
    if lo is not None:
        cond = cond & (col >= lo)
    if hi is not None:
        cond = cond & (col < hi)
    return cond


def dedup(df: DataFrame, keys: list[str]) -> DataFrame:
    """``GROUP BY keys`` without aggregates: distinct on the keys.

    Runs as a hash aggregate with partial combine, so exact copies collapse
    before the shuffle whatever their number.
    """
    return df.select(*keys).distinct()


def split_sum(value: Column, pred: Column) -> tuple[Column, Column]:
    """Sums of ``value`` where ``pred`` is true and where it is false; rows
    with a NULL predicate count in neither (SQL three-valued logic)."""
    return (F.sum(F.when(pred, value)), F.sum(F.when(~pred, value)))


def exact_values(value: Column, scale: int | None) -> Column:
    """Optionally sum in fixed point, so the total does not depend on the
    order in which partitions are combined."""
    return value if scale is None else value.cast(f"decimal(18,{scale})")
