"""Row-level helpers shared by the parsers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed(df: DataFrame, cols: list[Column]) -> DataFrame:
    """``df.select(*cols)``, evaluated once per row.

    The columns are produced through a one-element ``inline`` generator.  A
    later filter on them (for instance "no reject reason") then stays above
    the generator instead of being pushed below the projection with the
    expressions substituted in — which would parse each JSON line once per
    reference instead of once.
    """
    return df.select(F.inline(F.array(F.struct(*cols))))
