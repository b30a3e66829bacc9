"""Label lookups and the working-hours rule, as Catalyst expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# ---- fixed values (must equal the source system's codes) -------------------
# Productivity codes -2..2, in code order.
PRODUCTIVITY_LABELS = ["very distracting", "distracting", "neutral",
                       "productive", "very productive"]
# Fitness activity type codes that carry a label.
ACTIVITY_TYPE_LABELS = {7: "Walking*", 72: "Sleeping"}
# Activity types that count as sleep.
SLEEP_ACTIVITY_TYPES = [72, 109, 111]
# Working hours: Monday..Friday (1 = Sunday), local hours 9..19 inclusive.
WORKING_DAYS = [2, 3, 4, 5, 6]
WORKING_FIRST_HOUR = 9
WORKING_LAST_HOUR = 19
WORKING_LABEL = "Working hours"
OUTSIDE_WORKING_LABEL = "Outside working hours"
# ----------------------------------------------------------------------------


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def productivity_label(code) -> Column:
    """Code -2..2 → label; NULL or out-of-range code → NULL."""
    labels = F.array(*[F.lit(s) for s in PRODUCTIVITY_LABELS])
    code = _c(code)
    return F.when((code >= -2) & (code <= 2),
                  F.get(labels, (code + 2).cast("int")))


def productivity_code_valid(code) -> Column:
    return _c(code).isNotNull() & (_c(code) >= -2) & (_c(code) <= 2)


def activity_type_label(code) -> Column:
    """Activity type code → label via a literal map (NULL for unknown codes)."""
    pairs = []
    for k, v in ACTIVITY_TYPE_LABELS.items():
        pairs += [F.lit(k).cast("long"), F.lit(v)]
    return F.try_element_at(F.create_map(*pairs), _c(code).cast("long"))


def is_productive(label) -> Column:
    """``LIKE '%productive%'``: exactly 'productive' and 'very productive'."""
    return _c(label).like("%productive%")


def is_working_time(local_ts_col, days=WORKING_DAYS, first_hour: int = WORKING_FIRST_HOUR,
                    last_hour: int = WORKING_LAST_HOUR) -> Column:
    """Weekday (1 = Sunday) in ``days`` and local hour in
    ``first_hour..last_hour`` inclusive (three-valued)."""
    ts = _c(local_ts_col)
    hour = F.hour(ts)
    return (F.dayofweek(F.to_date(ts)).isin(*days)
            & (hour >= first_hour) & (hour <= last_hour))


def working_hours_label(local_ts_col, days=WORKING_DAYS, first_hour: int = WORKING_FIRST_HOUR,
                        last_hour: int = WORKING_LAST_HOUR) -> Column:
    """Label; a NULL condition takes the 'outside' branch, like SQL IF."""
    return F.when(is_working_time(local_ts_col, days, first_hour, last_hour),
                  F.lit(WORKING_LABEL)).otherwise(F.lit(OUTSIDE_WORKING_LABEL))
