"""Order-independent float sums against exact rational arithmetic."""

import math
import random
import struct
from fractions import Fraction

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from daycut.operators.exact import exact_sum_by
from daycut.plans import reports
from daycut.plans.standins import CALORIES_TYPE, DISTANCE_TYPE, HEART_RATE_TYPE
from daycut.sources import calendar as calmod


def exact(values):
    """The sum of finite doubles, rounded once."""
    total = sum((Fraction(v) for v in values), Fraction(0))
    try:
        return total.numerator / total.denominator
    except OverflowError:
        return math.inf if total > 0 else -math.inf


def sums(spark, groups, parts=3):
    rows = [(g, v) for g, values in enumerate(groups) for v in values]
    random.Random(1).shuffle(rows)
    frame = spark.createDataFrame(rows, "g int, v double").repartition(parts)
    out = exact_sum_by(frame, ["g"], F.col("v"), "s", {"n": ("count", F.col("v")), "lo": ("min", F.col("v")), "hi": ("max", F.col("v"))})
    return {r.g: r for r in out.collect()}


CASES = [[0.1] * 10, [1e15, 1.5, -1e15, 1.0], [1e300, 1.0, -1e300], [5e-324] * 3, [1.7e308, -1.7e308, 2.5], [2.0**53, 1.0, 1.0],
         [2.0**53, 1.0], [-0.0, 0.0], [1e-310, 2.0**-1000, -1e-310], [-3.25], [-0.1] * 7, [2.0**24, 2.0**48 - 1, 2.0**72],
         [1.0, 2.0**-53, 2.0**-106], [1.0, 2.0**-53], [1.0, 2.0**-52, 2.0**-53], [1.7e308] * 2, [-1.0, 2.0**-60], [2.0**-24, -(2.0**-24)]]


def test_known_cases(spark):
    got = sums(spark, CASES)
    for g, values in enumerate(CASES):
        assert got[g].s == exact(values), values
        assert (got[g].n, got[g].lo, got[g].hi) == (len(values), min(values), max(values))


def test_nulls_and_odd_values(spark):
    got = sums(spark, [[None, None], [None, 2.5], [math.nan, 1.0], [math.inf, 1.0], [math.inf, -math.inf]])
    assert got[0].s is None and got[0].n == 0 and got[1].s == 2.5 and got[1].n == 1
    assert math.isnan(got[2].s) and got[3].s == math.inf and math.isnan(got[4].s)


def test_any_bits(spark):
    rng = random.Random(7)
    groups = []
    for _ in range(300):
        values = [struct.unpack("<d", struct.pack("<Q", rng.getrandbits(64)))[0] for _ in range(rng.randrange(1, 12))]
        values = [v for v in values if math.isfinite(v)] or [0.0]
        groups.append(values + [-v for v in values[1:]])
    got = sums(spark, groups)
    assert all(got[g].s == exact(v) for g, v in enumerate(groups))


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.floats(allow_nan=False, allow_infinity=False), min_size=1, max_size=30), min_size=1, max_size=30),
       st.integers(1, 6))
def test_sums_property(spark, groups, parts):
    got = sums(spark, groups, parts)
    assert all(got[g].s == exact(v) for g, v in enumerate(groups))


@pytest.mark.parametrize("report,kind,column", [("daily_distance", DISTANCE_TYPE, "distance"), ("daily_calories", CALORIES_TYPE, "calrories"),
                                                ("daily_heart_rate", HEART_RATE_TYPE, "avg_heart_rate")])
def test_reports_by_default(spark, report, kind, column):
    """1e15 beside small values, in any partitioning: the exact sum, rounded."""
    values = [1e15, 0.5, -1e15, 1.0, 1.0] + [0.1] * 25
    cal = calmod.calendar_days(spark, "2024-01-09", "2024-01-09", "UTC")
    want = exact(values) / (len(values) if report == "daily_heart_rate" else 1)
    for seed in range(4):
        random.Random(seed).shuffle(values)
        pts = spark.createDataFrame([("u", kind, 1704790800000000000 + i, v, None) for i, v in enumerate(values)],
                                    "user_id string, dataTypeName string, startTimeNanos long, value0_fpVal double, value0_intVal long")
        out = getattr(reports, report)(pts.repartition(seed + 1), cal, tz="UTC", start="2024-01-09", end="2024-01-09").collect()
        assert out[0][column] == math.floor(want + 0.5)
