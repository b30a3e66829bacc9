"""Daily reports against a pure-Python computation on random small fixtures."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st

from daycut.plans import reports
from daycut.sources import calendar as calmod

TZ_HOURS = 9                       # Asia/Seoul, no DST
START, END = dt.date(2024, 1, 1), dt.date(2024, 1, 10)
T0 = int(dt.datetime(2023, 12, 30, tzinfo=dt.timezone.utc).timestamp() * 1000)
T1 = int(dt.datetime(2024, 1, 12, tzinfo=dt.timezone.utc).timestamp() * 1000)


def local(ms):
    return dt.datetime.fromtimestamp(ms / 1000, dt.timezone.utc) + dt.timedelta(hours=TZ_HOURS)


def days():
    return [START + dt.timedelta(days=i) for i in range((END - START).days + 1)]


# sub-millisecond parts away from the .5 ms tie (float rounding of ns/1e6)
sub_ms = st.one_of(st.integers(0, 400_000), st.integers(600_000, 999_999))
point = st.tuples(st.integers(T0, T1), sub_ms, st.integers(0, 1000), st.booleans())


@settings(max_examples=12, deadline=None)
@given(st.lists(point, max_size=40))
def test_daily_steps_matches_python(spark, pts):
    rows = [("u", "d", ms * 1_000_000 + sub, ms * 1_000_000 + sub,
             "com.google.step_count.delta" if is_step else "other", None, v)
            for ms, sub, v, is_step in pts]
    df = spark.createDataFrame(rows, "user_id string, dataSourceId string, "
                                     "startTimeNanos long, endTimeNanos long, "
                                     "dataTypeName string, value0_fpVal double, "
                                     "value0_intVal long")
    cal = calmod.calendar_days(spark, START, END, "Asia/Seoul")
    got = {r.date: r.step_count for r in reports.daily_steps(
        df, cal, start=START, end=END, ordered=False).collect()}
    want = {d: 0 for d in days()}
    for ms, sub, v, is_step in pts:
        d = local(ms + (1 if sub >= 500_000 else 0)).date()
        if is_step and d in want:
            want[d] += v
    assert got == want


act = st.tuples(st.integers(T0, T1), st.integers(0, 3600), st.integers(-2, 2))
LABELS = ["very distracting", "distracting", "neutral", "productive", "very productive"]


@settings(max_examples=12, deadline=None)
@given(st.lists(act, max_size=40))
def test_daily_productive_matches_python(spark, acts):
    rows = [("u", ms, secs, "a", "c", LABELS[code + 2], code) for ms, secs, code in acts]
    df = spark.createDataFrame(rows, "user_id string, date_timestamp_millis long, "
                                     "time_spent_seconds long, activity string, "
                                     "category string, productivity_string string, "
                                     "productivity long")
    cal = calmod.calendar_days(spark, START, END, "Asia/Seoul")
    got = {r.date: (r.working_time_sec, r.outside_working_time_sec, r.total_time_sec)
           for r in reports.daily_productive(df, cal, start=START, end=END,
                                             ordered=False).collect()}
    want = {d: [0, 0] for d in days()}
    for ms, secs, code in acts:
        t = local(ms)
        if code < 1 or t.date() not in want:
            continue
        sunday_first = (t.isoweekday() % 7) + 1          # 1 = Sunday … 7 = Saturday
        working = sunday_first in (2, 3, 4, 5, 6) and 9 <= t.hour <= 19
        want[t.date()][0 if working else 1] += secs
    assert got == {d: (w, o, w + o) for d, (w, o) in want.items()}


session = st.tuples(st.integers(T0, T1), st.integers(0, 600), st.sampled_from(["a", "b"]),
                    st.sampled_from([72, 109, 111, 7]), st.booleans())
W_LO = int(dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc).timestamp() * 1000)
W_HI = int(dt.datetime(2024, 1, 9, tzinfo=dt.timezone.utc).timestamp() * 1000)
STEP = 1_800_000


def py_pieces(s, e):
    """Clipped to the window: one more piece than whole steps fit, each a step
    long or up to the end."""
    s, e = max(s, W_LO), min(e, W_HI)
    if e - s <= STEP:
        return [(s, e)]
    return [(s + i * STEP, min(s + (i + 1) * STEP, e)) for i in range((e - s) // STEP + 1)]


@settings(max_examples=12, deadline=None)
@given(st.lists(session, max_size=30))
def test_daily_sleep_matches_python(spark, sessions):
    from daycut.operators import intervals
    rows = []
    for start, minutes, app, kind, dup in sessions:
        row = ("u", start, start + minutes * 60_000, app, kind)
        rows += [row, row] if dup else [row]               # duplicates collapse
    df = spark.createDataFrame(rows, "user_id string, startTimeMillis long, "
                                     "endTimeMillis long, application_packageName string, "
                                     "activityType long")
    df = intervals.split_intervals(intervals.clip_intervals(
        df, "startTimeMillis", "endTimeMillis", W_LO, W_HI), "startTimeMillis", "endTimeMillis")
    cal = calmod.calendar_days(spark, START, END, "Asia/Seoul")
    got = {r.date: r.sleep_sec for r in reports.daily_sleep(
        df, cal, start=START, end=END, ordered=False).collect()}
    pieces = set()
    for start, minutes, app, kind, _ in sessions:
        if kind in (72, 109, 111):
            for s, e in py_pieces(start, start + minutes * 60_000):
                pieces.add(("u", s, e, app))
    per_app = {}
    for _, s, e, app in pieces:
        d = (local(s) + dt.timedelta(hours=5)).date()
        per_app[(d, app)] = per_app.get((d, app), 0) + (e - s)
    want = {d: None for d in days()}
    for (d, app), ms in per_app.items():
        if d in want:
            want[d] = ms / 1000 if want[d] is None else max(want[d], ms / 1000)
    assert got == want
