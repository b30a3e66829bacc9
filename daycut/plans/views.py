"""The reports as SQL temp views over warehouse tables (S9: views on views).

    register_views(spark, {"points": path, "sessions": path,
                           "time_tracking": path}, start="2018-07-01")
    spark.sql("SELECT * FROM daily_steps WHERE date >= '2024-01-01'")

Each view is the DataFrame of ``plans.reports`` registered under the report's
name; the calendar is registered as ``calendar_days`` and reused by every
report, as the warehouse views reuse the calendar view.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from daycut.plans import reports
from daycut.sinks import users, warehouse
from daycut.sources import calendar as calmod

VIEW_NAMES = ["calendar_days", "daily_calories", "daily_distance", "daily_steps",
              "daily_heart_rate", "daily_sleep", "daily_productive",
              "daily_productive_details"]


def register_views(spark: SparkSession, tables: dict[str, str], *,
                   start=calmod.DEFAULT_START, end=None, tz: str = reports.TZ,
                   user_id: str | None = None, by_user: bool = False,
                   prefix: str = "") -> list[str]:
    """Register the calendar and the eight reports as temp views.

    ``tables`` maps ``points``/``sessions``/``time_tracking`` to warehouse
    tables (folders, or names in the catalog); missing tables skip their
    reports.  With ``end=None`` the calendar ends yesterday in ``tz`` whenever a
    view is queried: the bound is an expression that each query folds to a
    literal, so the scans still prune by day.  ``end`` may also be a date or an
    expression of one's own.

    A view over a table in the catalog sees later loads.  One over a folder
    shows the loads published when it was registered: register the views again
    after a load (no data is read).  Per-user views take their users from the
    user dimension that the loads keep, where there is one.
    """
    end = calmod.yesterday(tz) if end is None else end
    cal = calmod.calendar_days(spark, start, end, tz)
    kw = dict(tz=tz, user_id=user_id, start=start, end=end, day_col=warehouse.DAY_COL, by_user=by_user)
    views = {"calendar_days": reports.newest_first(cal, True)}

    def over(kind: str, *names: str) -> None:
        if kind in tables:
            facts = warehouse.read_table(spark, tables[kind])
            asked = users.read_users(spark, tables[kind]) if by_user else None
            views.update({n: getattr(reports, n)(facts, cal, users=asked, **kw) for n in names})

    over("points", "daily_calories", "daily_distance", "daily_steps", "daily_heart_rate")
    over("sessions", "daily_sleep")
    over("time_tracking", "daily_productive", "daily_productive_details")
    for name, df in views.items():
        df.createOrReplaceTempView(prefix + name)
    return [prefix + n for n in views]
