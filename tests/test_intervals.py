"""Clip and split semantics (FIXTURES §4), plus properties of the split."""

from hypothesis import given, settings
from hypothesis import strategies as st

from daycut.operators import intervals

MIN = 60_000


def _pieces(spark, start_min, end_min, lo=0, hi=1440, **kw):
    df = spark.createDataFrame([("s", start_min * MIN, end_min * MIN)],
                               "id string, s long, e long")
    df = intervals.clip_intervals(df, "s", "e", lo * MIN, hi * MIN)
    out = intervals.split_intervals(df, "s", "e", **kw).orderBy("s").collect()
    return [(r.s // MIN, r.e // MIN) for r in out]


def test_fixture_cases(spark):
    cases = {
        (0, 20): [(0, 20)],
        (0, 30): [(0, 30)],
        (0, 75): [(0, 30), (30, 60), (60, 75)],
        (0, 60): [(0, 30), (30, 60), (60, 60)],
        (-40, 20): [(0, 20)],
        (1430, 1500): [(1430, 1440)],
        (-90, -30): [(0, -30)],
    }
    for (a, b), want in cases.items():
        assert _pieces(spark, a, b) == want, (a, b)


def test_drop_options(spark):
    assert _pieces(spark, 0, 60, drop_empty=True) == [(0, 30), (30, 60)]
    assert _pieces(spark, -90, -30, drop_inverted=True) == []


def test_other_columns_copied(spark):
    df = spark.createDataFrame([("x", 7, 0, 100 * MIN)], "id string, k int, s long, e long")
    out = intervals.split_intervals(df, "s", "e").collect()
    assert len(out) == 4 and {(r.id, r.k) for r in out} == {("x", 7)}
    assert out[0].asDict().keys() == {"id", "k", "s", "e"}


@settings(max_examples=25, deadline=None)
@given(st.integers(-200, 1600), st.integers(0, 400))
def test_split_properties(spark, start, length):
    end = start + length
    pieces = _pieces(spark, start, end)
    cs, ce = max(start, 0), min(end, 1440)
    if ce - cs <= 30:
        assert pieces == [(cs, ce)]
        return
    assert pieces[0][0] == cs and pieces[-1][1] == ce
    assert all(e - s <= 30 for s, e in pieces)
    assert all(pieces[i][1] == pieces[i + 1][0] for i in range(len(pieces) - 1))
    assert sum(e - s for s, e in pieces) == ce - cs
