"""Interval clip and split (row-local: no shuffle, one ``explode``).

Sessions are stored in pieces of at most 30 minutes so that any time zone's
local day can be cut from them later.  Semantics of the split, with
``d = end - start`` after clipping and ``step`` the piece length:

* ``d <= step`` (also ``d == 0`` and negative ``d``): the row, unchanged;
* ``d > step``: pieces starting at ``start, start+step, …`` while the
  previous piece did not already pass ``end``; the last piece ends at ``end``.
  When ``d`` is an exact multiple of ``step`` this yields one trailing
  zero-length piece ``(end, end)``;
* a session wholly outside the window is clipped to ``start > end`` and kept
  as one row of negative length.

``drop_empty``/``drop_inverted`` remove the last two artefacts on request.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STEP_MS = 1_800_000


def _lit_or_col(x):
    if isinstance(x, Column):
        return x
    return F.col(x) if isinstance(x, str) else F.lit(x)


def clip_intervals(df: DataFrame, start: str, end: str, lo, hi) -> DataFrame:
    """``start = max(start, lo)``, ``end = min(end, hi)``; ``lo``/``hi`` are
    epoch values, column names or expressions (a per-row window)."""
    s, e = F.col(start), F.col(end)
    lo_c, hi_c = _lit_or_col(lo), _lit_or_col(hi)
    return df.withColumn(start, F.when(s < lo_c, lo_c).otherwise(s)) \
             .withColumn(end, F.when(e > hi_c, hi_c).otherwise(e))


def split_intervals(df: DataFrame, start: str, end: str, step: int = STEP_MS,
                    drop_empty: bool = False, drop_inverted: bool = False) -> DataFrame:
    """One row per piece; all other columns are copied to every piece.

    Run it after ``clip_intervals`` (as the load jobs do): the clip bounds
    the pieces per row by the window length (49 for a day), so a corrupt
    multi-year session cannot blow up one task.
    """
    s, e = F.col(start), F.col(end)
    # a length beyond the type's range (a corrupt row) is no length: one piece
    long_ = F.coalesce(F.try_subtract(e, s) > F.lit(step), F.lit(False))
    piece = F.explode(F.when(long_, F.sequence(s, e, F.lit(step).cast("long")))
                      .otherwise(F.array(s)))
    others = [c for c in df.columns if c not in (start, end)]
    out = df.select(*others, s.alias("__s"), e.alias("__e"), long_.alias("__long"),
                    piece.alias("__p"))
    out = out.select(
        *others,
        F.col("__p").alias(start),
        F.when(F.col("__long"), F.least(F.col("__p") + F.lit(step), F.col("__e")))
         .otherwise(F.col("__e")).alias(end))
    if drop_empty:
        out = out.filter(F.col(end) != F.col(start))
    if drop_inverted:
        out = out.filter(F.col(end) >= F.col(start))
    return out.select(*df.columns)
