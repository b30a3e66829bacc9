"""Landing parsers, the lake writer/scan and the day-partition load."""

import glob
import json
import os
import threading

from pyspark.sql import functions as F

from daycut.plans import catalog_io, jobs, landed, standins
from daycut.sinks import lake, warehouse
from daycut.sources import landing


def test_matrix_fixture(spark):
    doc = {"row_headers": ["Date", "Time Spent (seconds)", "Activity", "Category",
                           "Productivity"],
           "rows": [["2020-05-16T08:00:00", 120, "editor", "Dev", 2],
                    ["2020-05-16T09:00:00", 60, "mail", "Mail", -1]]}   # numbers as numbers
    docs = landing.envelopes_from_text(spark.createDataFrame([(json.dumps(doc),)], "value string"),
                                       landing.MATRIX_ENVELOPE)
    out = landing.parse_matrix(docs, load_tz="Asia/Seoul", output_date="2020-05-16",
                               output_tz="UTC", user_id="u1").collect()
    assert len(out) == 1
    f = out[0].fields
    assert f["date_timestamp_millis"] == "1589587200000"
    assert f["time_spent_(seconds)"] == "60" and f["date"] == "2020-05-16T09:00:00"
    assert f["productivity"] == "-1"


def test_matrix_rejects(spark):
    docs = [{"row_headers": ["Time"], "rows": [["x"]]},                       # no date header
            {"row_headers": ["Date"], "rows": [["2020-13-45T99:00:00"]]}]     # bad date
    df = landing.envelopes_from_text(
        spark.createDataFrame([(json.dumps(d),) for d in docs], "value string"),
        landing.MATRIX_ENVELOPE)
    out = landing.parse_matrix(df, load_tz="UTC", output_date="2020-05-16", user_id="u")
    reasons = sorted(r[landing.REASON] for r in out.collect())
    assert reasons == ["no date header", "unparsable date"]


def test_aggregated_three_levels(spark):
    doc = {"bucket": [
        {"startTimeMillis": "0", "endTimeMillis": "1800000", "dataset": [
            {"dataSourceId": "s1", "point": [
                {"startTimeNanos": "1", "endTimeNanos": "2", "dataTypeName": "t",
                 "value": [{"intVal": 3}]}]},
            {"dataSourceId": "s2", "point": []}]},
        {"startTimeMillis": "1800000", "endTimeMillis": "3600000", "dataset": []}]}
    docs = landing.envelopes_from_text(spark.createDataFrame([(json.dumps(doc),)],
                                                             "value string"),
                                       landing.AGGREGATED_ENVELOPE)
    rows = landing.parse_aggregated(docs, user_id="u").collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r.user_id, r.startTimeMillis, r.dataSourceId, r.startTimeNanos) == ("u", "0", "s1", "1")


def test_sessions_label_and_user(spark):
    doc = {"session": [{"id": "a", "startTimeMillis": "1", "endTimeMillis": "2",
                        "activityType": 72},
                       {"id": "b", "startTimeMillis": "1", "endTimeMillis": "2",
                        "activityType": 5}]}
    docs = landing.envelopes_from_text(spark.createDataFrame([(json.dumps(doc),)],
                                                             "value string"),
                                       landing.SESSIONS_ENVELOPE)
    rows = {r.id: r for r in landing.parse_sessions(docs, user_id="u1").collect()}
    assert rows["a"].activityType_String == "Sleeping" and rows["b"].activityType_String is None
    assert rows["a"].user_id == "u1"


def test_read_envelope_files(spark, tmpdir_path):
    good = os.path.join(tmpdir_path, "a.json")
    with open(good, "w") as fh:
        json.dump({"dataSource": [{"dataStreamId": "x"}, {"dataStreamId": "y"}]}, fh, indent=2)
    with open(os.path.join(tmpdir_path, "b.json"), "w") as fh:
        fh.write("{broken")
    docs = landing.read_envelopes(spark, tmpdir_path, landing.DATASOURCES_ENVELOPE)
    ok, bad = landing.split_documents(docs, ["dataSource"])
    assert bad.count() == 1
    assert sorted(r.dataStreamId for r in landing.parse_datasources(ok, user_id="u").collect()) \
        == ["x", "y"]


def test_sharded_writer_and_scan(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "lake")
    n = 500
    df = spark.range(n).select(
        F.lit("2024-01-01").cast("date").alias("day"), F.lit("ds").alias("dataset"),
        F.to_json(F.struct(F.col("id"))).alias("value"))
    lake.write_sharded_jsonl(df, root, shards=3)
    files = glob.glob(f"{root}/load=*/day=2024-01-01/dataset=ds/bucket=*/part-*")
    assert 1 <= len(files) <= 3
    back = lake.scan_jsonl(spark, root, day="2024-01-01", dataset="ds")
    assert back.count() == n
    assert back.select(F.get_json_object("value", "$.id").cast("long").alias("i")) \
        .agg(F.sum("i")).collect()[0][0] == n * (n - 1) // 2
    # re-landing the prefix replaces it
    lake.write_sharded_jsonl(df.limit(10), root, shards=3)
    assert lake.scan_jsonl(spark, root, day="2024-01-01", dataset="ds").count() == 10


def test_load_partition_truncates(spark, tmpdir_path):
    table = os.path.join(tmpdir_path, "t")
    rows = spark.createDataFrame([("u1", 1), ("u2", 2)], "user_id string, v long")
    warehouse.load_partition(rows, table, "2024-01-01", cluster_by=["user_id"], files=2)
    warehouse.load_partition(rows, table, "2024-01-02", cluster_by=["user_id"], files=2)
    warehouse.load_partition(rows, table, "2024-01-01", cluster_by=["user_id"], files=2)
    t = warehouse.read_table(spark, table)
    assert t.count() == 4
    warehouse.load_partition(rows.limit(0), table, "2024-01-01")
    t = warehouse.read_table(spark, table)
    assert t.count() == 2 and {r.day.isoformat() for r in t.collect()} == {"2024-01-02"}


def test_reload_days_windows():
    ws = jobs.reload_days("2024-01-10")
    assert [w.day.isoformat() for w in ws] == ["2024-01-09", "2024-01-10"]
    assert ws[1].begin_ms - ws[0].begin_ms == 86_400_000
    assert ws[0].end_ms == ws[1].begin_ms


def test_load_jobs_end_to_end(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "lake")
    day = "2024-01-09"
    ses = [{"user_id": "u1", "id": "s", "startTimeMillis": "1704754800000",   # 23:00 on the 8th
            "endTimeMillis": "1704762000000", "application": {"packageName": "p"},
            "activityType": 72}]
    tt = [{"user_id": "u1", "date_timestamp_millis": "1704790800000",
           "time_spent_(seconds)": "60", "productivity": "1"},
          {"user_id": "u1", "productivity": "7"}]
    lines = spark.createDataFrame(
        [(day, "sessions", json.dumps(x)) for x in ses]
        + [(day, "time-tracking", json.dumps(x)) for x in tt],
        "day string, dataset string, value string").withColumn("day", F.col("day").cast("date"))
    lake.write_sharded_jsonl(lines, root)
    tables = {k: os.path.join(tmpdir_path, k) for k in ("points", "sessions", "time_tracking")}
    rej = os.path.join(tmpdir_path, "rejects")
    w = jobs.day_window(day)
    jobs.job_load_fitness(spark, root, tables["points"], tables["sessions"], w, rej)
    jobs.job_load_time_tracking(spark, root, tables["time_tracking"], w, rej)
    s = warehouse.read_table(spark, tables["sessions"]).orderBy("startTimeMillis").collect()
    # clipped to 00:00 of the 9th, 1 h left → two 30-minute pieces + zero-length tail
    assert [(r.startTimeMillis, r.endTimeMillis) for r in s] == [
        (1704758400000, 1704760200000), (1704760200000, 1704762000000),
        (1704762000000, 1704762000000)]
    t = warehouse.read_table(spark, tables["time_tracking"]).collect()
    assert len(t) == 1 and t[0].productivity_string == "productive"
    r = spark.read.parquet(os.path.join(rej, "dataset=time-tracking")).collect()
    assert len(r) == 1 and r[0].reason == "bad productivity code"


def test_scan_glob_line_ends(spark, tmpdir_path):
    d = os.path.join(tmpdir_path, "g")
    os.makedirs(d)
    with open(os.path.join(d, "20240101Z-u1-sessions-0-of-2.jsonl"), "wb") as fh:
        fh.write(b'{"a":1}\r\n\r\n{"a":2}\r\n')
    with open(os.path.join(d, "20240101Z-u1-other-0-of-1.jsonl"), "wb") as fh:
        fh.write(b'{"a":3}\n')
    rows = [r.value for r in lake.scan_glob(spark, d + "/20240101Z-*-sessions-*").collect()]
    assert sorted(rows) == ["", '{"a":1}', '{"a":2}']


def test_landing_jobs_from_files(spark, tmpdir_path):
    ses_dir = os.path.join(tmpdir_path, "ses")
    agg_dir = os.path.join(tmpdir_path, "agg")
    tt_dir = os.path.join(tmpdir_path, "tt")
    for d in (ses_dir, agg_dir, tt_dir):
        os.makedirs(d)
    with open(os.path.join(ses_dir, "a.json"), "w") as fh:
        json.dump({"session": [{"id": "s", "startTimeMillis": "1704758400000",
                                "endTimeMillis": "1704760200000",
                                "application": {"packageName": "p"}, "activityType": 72}]},
                  fh, indent=1)
    with open(os.path.join(agg_dir, "a.json"), "w") as fh:
        json.dump({"bucket": [{"startTimeMillis": "1704758400000",
                               "endTimeMillis": "1704760200000",
                               "dataset": [{"dataSourceId": "d", "point": [
                                   {"startTimeNanos": "1704758400000000000",
                                    "endTimeNanos": "1704758460000000000",
                                    "dataTypeName": "com.google.step_count.delta",
                                    "value": [{"intVal": 12}]}]}]}]}, fh, indent=1)
    with open(os.path.join(tt_dir, "a.json"), "w") as fh:
        json.dump({"row_headers": ["Date", "Time Spent (seconds)", "Productivity"],
                   "rows": [["2024-01-09T10:00:00", "60", "1"],
                            ["2024-01-09T08:00:00", "30", "2"]]}, fh)
    root = os.path.join(tmpdir_path, "lake")
    jobs.job_land_fitness(spark, ses_dir, agg_dir, root, "2024-01-09", "u1")
    rejected = jobs.job_land_time_tracking(spark, tt_dir, root, "2024-01-09", "u1",
                                           load_tz="Asia/Seoul")
    assert rejected.count() == 0
    ses = lake.scan_jsonl(spark, root, day="2024-01-09", dataset="sessions").collect()
    assert len(ses) == 1 and json.loads(ses[0].value)["user_id"] == "u1"
    pts, _ = jobs.point_rows(lake.scan_jsonl(spark, root, day="2024-01-09",
                                             dataset="aggregated-datasets"))
    assert [r.value0_intVal for r in pts.collect()] == [12]
    # 10:00 Seoul is 01:00 UTC on the 9th (kept); 08:00 Seoul is the 8th in UTC
    tt, _ = jobs.time_tracking_rows(lake.scan_jsonl(spark, root, day="2024-01-09",
                                                    dataset="time-tracking"))
    rows = tt.collect()
    assert [(r.date_timestamp_millis, r.time_spent_seconds) for r in rows] == [
        (1704762000000, 60)]


def test_run_reload_two_days(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "lake")
    line = {"user_id": "u1", "id": "s", "startTimeMillis": "1704754800000",
            "endTimeMillis": "1704762000000", "activityType": 72}
    lines = spark.createDataFrame(
        [(d, "sessions", json.dumps(line)) for d in ("2024-01-08", "2024-01-09")],
        "day string, dataset string, value string").withColumn("day", F.col("day").cast("date"))
    lake.write_sharded_jsonl(lines, root)
    tables = {k: os.path.join(tmpdir_path, k) for k in ("points", "sessions", "time_tracking")}
    jobs.run_reload(spark, "2024-01-09", root, tables)
    jobs.run_reload(spark, "2024-01-09", root, tables)       # a re-run replaces
    s = warehouse.read_table(spark, tables["sessions"])
    got = sorted((r.day.isoformat(), r.startTimeMillis, r.endTimeMillis) for r in s.collect())
    # the session crossing midnight is cut at the day boundary, no duplicates
    assert sum(e - b for _, b, e in got) == 1704762000000 - 1704754800000
    assert {d for d, _, _ in got} == {"2024-01-08", "2024-01-09"}
    assert warehouse.read_table(spark, tables["points"]).count() == 0


def test_matrix_calendar_day_window_on_dst_change(spark):
    # 2024-03-10 in New York has 23 hours; 00:30 on the 11th is 04:30 UTC,
    # inside a fixed 24 h window from 05:00 UTC but outside the local day
    doc = {"row_headers": ["Date"], "rows": [["2024-03-10T23:30:00"], ["2024-03-11T00:30:00"]]}
    docs = landing.envelopes_from_text(spark.createDataFrame([(json.dumps(doc),)],
                                                             "value string"),
                                       landing.MATRIX_ENVELOPE)
    kw = dict(load_tz="America/New_York", output_date="2024-03-10",
              output_tz="America/New_York", user_id="u")
    fixed = landing.parse_matrix(docs, **kw).collect()
    local = landing.parse_matrix(docs, fixed_day=False, **kw).collect()
    assert len(fixed) == 2
    assert [r.fields["date"] for r in local] == ["2024-03-10T23:30:00"]


def test_views_over_loaded_tables(spark, tmpdir_path):
    """Load a day, register the report views and query them with SQL."""
    from daycut.plans import views
    root = os.path.join(tmpdir_path, "lake")
    day = "2024-01-09"
    pts = [{"user_id": "u1", "dataSourceId": "d", "startTimeNanos": "1704790800000000000",
            "endTimeNanos": "1704790860000000000",
            "dataTypeName": "com.google.step_count.delta", "value": [{"intVal": 42}]}]
    tt = [{"user_id": "u1", "date_timestamp_millis": "1704790800000",
           "time_spent_(seconds)": "60", "productivity": "2"}]
    lines = spark.createDataFrame(
        [(day, "aggregated-datasets", json.dumps(x)) for x in pts]
        + [(day, "time-tracking", json.dumps(x)) for x in tt],
        "day string, dataset string, value string").withColumn("day", F.col("day").cast("date"))
    lake.write_sharded_jsonl(lines, root)
    tables = {k: os.path.join(tmpdir_path, k) for k in ("points", "sessions", "time_tracking")}
    w = jobs.day_window(day)
    jobs.job_load_fitness(spark, root, tables["points"], tables["sessions"], w)
    jobs.job_load_time_tracking(spark, root, tables["time_tracking"], w)
    names = views.register_views(spark, tables, start="2024-01-08", end="2024-01-10",
                                 prefix="t_")
    assert set(names) == {"t_" + n for n in views.VIEW_NAMES}
    steps = {r.date.isoformat(): r.step_count for r in
             spark.sql("SELECT date, step_count FROM t_daily_steps").collect()}
    assert steps == {"2024-01-08": 0, "2024-01-09": 42, "2024-01-10": 0}
    prod = spark.sql("SELECT * FROM t_daily_productive WHERE date = '2024-01-09'").collect()
    assert prod[0].working_time_sec == 60                 # 18:00 Seoul on a Tuesday
    assert spark.sql("SELECT count(*) AS n FROM t_calendar_days").collect()[0].n == 3
    # per-user views: one dense series per user of each table
    views.register_views(spark, tables, start="2024-01-08", end="2024-01-10",
                         by_user=True, prefix="pu_")
    per_user = spark.sql("SELECT user_id, date, step_count FROM pu_daily_steps").collect()
    assert sorted((r.user_id, r.date.isoformat(), r.step_count) for r in per_user) == [
        ("u1", "2024-01-08", 0), ("u1", "2024-01-09", 42), ("u1", "2024-01-10", 0)]


def test_land_many_users_with_their_zones(spark, tmpdir_path):
    docs_root = os.path.join(tmpdir_path, "answers")
    for user, rows in (("u1", [["2024-01-09T10:00:00", 60, "a", "c", 1]]),
                       ("u2", [["2024-01-09T10:00:00", 30, "b", "c", 2]]),
                       ("u3", [["2024-01-09T10:00:00", 5, "x", "c", 0]])):
        d = os.path.join(docs_root, f"user={user}")
        os.makedirs(d)
        with open(os.path.join(d, "a.json"), "w") as fh:
            json.dump({"row_headers": ["Date", "Time Spent (seconds)", "Activity",
                                       "Category", "Productivity"], "rows": rows}, fh)
    zones = spark.createDataFrame([("u1", "Asia/Seoul"), ("u2", "America/New_York")],
                                  "user_id string, tz string")
    root = os.path.join(tmpdir_path, "lake")
    rejected = jobs.job_land_time_tracking_users(spark, docs_root, root, "2024-01-09", zones)
    tt, _ = jobs.time_tracking_rows(lake.scan_jsonl(spark, root, day="2024-01-09",
                                                    dataset="time-tracking"))
    got = {r.user_id: r.date_timestamp_millis for r in tt.collect()}
    # 10:00 in Seoul is 01:00 UTC; 10:00 in New York is 15:00 UTC
    assert got == {"u1": 1704762000000, "u2": 1704812400000}
    assert [r.user_id for r in rejected.collect()] == ["u3"]    # no zone → unparsable


def test_land_fitness_many_users(spark, tmpdir_path):
    ses_root = os.path.join(tmpdir_path, "ses")
    agg_root = os.path.join(tmpdir_path, "agg")
    for user in ("u1", "u2"):
        for root, doc in ((ses_root, {"session": [{"id": f"s-{user}", "startTimeMillis": "1",
                                                   "endTimeMillis": "2", "activityType": 72}]}),
                          (agg_root, {"bucket": [{"startTimeMillis": "0",
                                                  "endTimeMillis": "1800000",
                                                  "dataset": [{"dataSourceId": "d", "point": [
                                                      {"startTimeNanos": "1",
                                                       "endTimeNanos": "2",
                                                       "dataTypeName": "t",
                                                       "value": [{"intVal": 1}]}]}]}]})):
            os.makedirs(os.path.join(root, f"user={user}"), exist_ok=True)
            with open(os.path.join(root, f"user={user}", "a.json"), "w") as fh:
                json.dump(doc, fh)
    root = os.path.join(tmpdir_path, "lake")
    jobs.job_land_fitness_users(spark, ses_root, agg_root, root, "2024-01-09")
    ses, _ = jobs.session_rows(lake.scan_jsonl(spark, root, dataset="sessions"))
    assert sorted((r.user_id, r.id) for r in ses.collect()) == [("u1", "s-u1"), ("u2", "s-u2")]
    pts, _ = jobs.point_rows(lake.scan_jsonl(spark, root, dataset="aggregated-datasets"))
    assert sorted(r.user_id for r in pts.collect()) == ["u1", "u2"]


def _docs(spark, *texts):
    return spark.createDataFrame([("u1", t) for t in texts], f"__user string, {landing.TEXT} string")


def test_landing_keeps_every_key(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "lake")
    point = {"startTimeNanos": "1", "dataTypeName": "t", "dataSourceId": "own", "extra": None,
             "value": [{"intVal": 3, "mapVal": [{"key": "k", "value": {"fpVal": 0.5}}]}]}
    docs = {
        "sessions": {"session": [{"id": "a", "activityType": 72, "activeTimeMillis": "9", "user_id": "no"}]},
        "datasources": {"dataSource": [{"dataStreamId": "x", "device": {"uid": "d", "n": 1}}]},
        "raw_points": {"minStartTimeNs": "0", "maxEndTimeNs": "5", "dataSourceId": "s", "point": [point]},
        "points": {"bucket": [{"startTimeMillis": "0", "endTimeMillis": "1", "dataset": [
            {"dataSourceId": "s", "point": [point]}, {"dataSourceId": "e", "point": []}]}]}}
    got = {}
    for kind, doc in docs.items():
        parsed = landing.parsed_once(_docs(spark, json.dumps(doc)), jobs.FITNESS[kind][0])
        assert jobs.land_answers(parsed, kind, root, "2024-01-09", user_col="__user").count() == 0
        rows = lake.scan_jsonl(spark, root, dataset=jobs.DATASETS[kind]).collect()
        assert len(rows) == 1
        got[kind] = json.loads(rows[0].value)
    # user and label replace a session's own keys
    assert got["sessions"] == {"id": "a", "activityType": 72, "activeTimeMillis": "9",
                               "user_id": "u1", "activityType_String": "Sleeping"}
    assert got["datasources"] == {"dataStreamId": "x", "device": {"uid": "d", "n": 1}, "user_id": "u1"}
    # a point's own keys win over carried ones
    assert got["raw_points"] == {**point, "user_id": "u1", "minStartTimeNs": "0", "maxEndTimeNs": "5"}
    assert got["points"] == {**point, "user_id": "u1", "startTimeMillis": "0", "endTimeMillis": "1"}


def test_landing_returns_rejects_with_text(spark, tmpdir_path):
    root, table = os.path.join(tmpdir_path, "lake"), os.path.join(tmpdir_path, "rejects")
    texts = ["{broken", "", '{"other": 1}', '{"session": [{"id": "a"}, 5, null]}']
    parsed = landing.parsed_once(_docs(spark, *texts), landing.SESSIONS_RAW)
    rejects = jobs.land_answers(parsed, "sessions", root, "2024-01-09", user_col="__user",
                                rejects_table=table)
    want = sorted([("document", t) for t in texts[:3]]
                  + [("element is not an object", t) for t in ("5", "null")])
    key = "_reject_reason"
    assert sorted((r[key], "null" if r.text is None else r.text) for r in rejects.collect()) == want
    kept = [json.loads(r.value) for r in lake.scan_jsonl(spark, table, day="2024-01-09", dataset="sessions").collect()]
    assert sorted((r["reason"], r["text"]) for r in kept) == want and {r["user_id"] for r in kept} == {"u1"}
    assert lake.scan_jsonl(spark, root, dataset="sessions").count() == 1


def test_empty_landing_replaces_the_prefix(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "lake")
    for user in ("a b", "u/1=%"):
        for text, n in (('{"session": [{"id": "a"}]}', 1), ('{"session": []}', 0)):
            docs = landing.parsed_once(_docs(spark, text), landing.SESSIONS_RAW)
            jobs.land_answers(docs, "sessions", root, "2024-01-09", user_id=user, shards=3)
            assert lake.scan_jsonl(spark, root, users=[user]).count() == n


def test_matrix_headers_that_once_stopped_the_job(spark):
    docs = [{"row_headers": ["Date", None], "rows": [["2020-05-16T08:00:00", "x"]]},
            {"row_headers": ["Date", "User ID", "Date Timestamp Millis"],
             "rows": [["2020-05-16T08:00:00", "other", "7"]]}]
    df = landing.envelopes_from_text(
        spark.createDataFrame([(json.dumps(d),) for d in docs], "value string"), landing.MATRIX_ENVELOPE)
    out = landing.parse_matrix(df, load_tz="UTC", output_date="2020-05-16", user_id="u")
    assert [r[landing.REASON] for r in out.collect() if r[landing.REASON]] == ["header without a name"]
    line = json.loads(landing.matrix_row_json(out.filter(F.col(landing.REASON).isNull())).first().value)
    assert line == {"user_id": "u", "date": "2020-05-16T08:00:00", "date_timestamp_millis": "1589616000000"}


def test_last_of_equal_headers_wins(spark):
    doc = {"row_headers": ["Date", "Time Spent", "time_spent", "TIME SPENT", "Other"],
           "rows": [["2020-05-16T08:00:00", 1, 2, 3, "x"], ["2020-05-16T09:00:00", 1, 2], ["2020-05-16T10:00:00"],
                    ["2020-05-16T11:00:00", 1, 2, None, "y"]]}
    df = landing.envelopes_from_text(spark.createDataFrame([(json.dumps(doc),)], "value string"), landing.MATRIX_ENVELOPE)
    out = landing.parse_matrix(df, load_tz="UTC", output_date="2020-05-16", user_id="u").collect()
    assert all(r[landing.REASON] is None for r in out)
    got = {r.fields["date"][11:13]: (r.fields.get("time_spent", "-"), r.fields.get("other", "-")) for r in out}
    assert got == {"08": ("3", "x"), "09": ("2", "-"), "10": ("-", "-"), "11": (None, "y")}


def test_load_days_empties_days_without_rows(spark, tmpdir_path):
    table = f"{tmpdir_path}/days"
    rows = lambda *r: spark.createDataFrame(list(r), "user_id string, t long, day string") \
        .withColumn("day", F.col("day").cast("date"))
    read = lambda: {(r.user_id, str(r.day)) for r in warehouse.read_table(spark, table).collect()}
    days = ["2024-01-08", "2024-01-09"]
    warehouse.load_days(rows(), table, days)
    assert read() == set()
    warehouse.load_days(rows(("a", 1, "2024-01-08"), ("b", 2, "2024-01-09"), ("c", 3, "2024-01-10")), table,
                        [*days, "2024-01-10"], cluster_by=["user_id", "t"])
    warehouse.load_days(rows(("d", 1, "2024-01-08"), ("e", 9, "2024-01-10")), table, days)
    assert read() == {("d", "2024-01-08"), ("c", "2024-01-10")}      # the 10th is not of this load


def test_landing_reads_each_answer_once(spark, tmpdir_path):
    """One pass over the answers gives lines, rejects and the users landed by
    nothing; and a second landing keeps the other users' lines."""
    seen, root = spark.sparkContext.accumulator(0), os.path.join(tmpdir_path, "lake")

    def counted(text):
        seen.add(1)
        return text

    texts = {"u1": '{"bucket": [{"startTimeMillis": "1", "dataset": [{"dataSourceId": "d", "point": ['
                   '{"a": "é\\"", "user_id": null, "startTimeMillis": null}, {}, 3, null]}, {"point": []}]}, null]}',
             "u2": "{broken", "u3": '{"bucket": []}', "u4": "[]", "u5": '{"bucket": [{"dataset": [{"point": [{"b": 1}]}]}]}'}

    def land(users):
        docs = spark.createDataFrame([(u, texts[u]) for u in users], f"__user string, {landing.TEXT} string") \
            .withColumn(landing.TEXT, F.udf(counted, "string")(landing.TEXT))
        got = jobs.land_answers(landing.parsed_once(docs, jobs.FITNESS["points"][0]), "points", root, "2024-01-09",
                                user_col="__user")
        return sorted((r.user_id, r[landing.REASON], r.text or "") for r in got.collect())

    assert land(["u1", "u2", "u3", "u4"]) == [
        ("u1", "element is not an object", "3"), ("u1", "element is not an object", "null"),
        ("u2", "document", "{broken"), ("u4", "document", "[]")]
    assert seen.value == 4
    lines = lake.scan_jsonl(spark, root, day="2024-01-09")
    own = {"user_id": "u1", "startTimeMillis": "1", "dataSourceId": "d"}
    assert sorted((json.loads(r.value) for r in lines.collect()), key=len) == [
        own, {"user_id": "u1", "a": "é\"", "startTimeMillis": None, "dataSourceId": "d"}]
    texts["u1"] = '{"bucket": []}'
    assert land(["u5"]) == [] and len(lake.scan_jsonl(spark, root, day="2024-01-09").collect()) == 3
    assert land(["u1"]) == []                                    # replaced by nothing
    assert [json.loads(r.value) for r in lake.scan_jsonl(spark, root, day="2024-01-09").collect()] == [
        {"user_id": "u5", "b": 1}]


def test_lake_writes_by_a_user_column(spark, tmpdir_path):
    """Lines go to the bucket of the user column, the same that their text
    tells; the lists alone give the days."""
    rows = spark.createDataFrame([("2024-01-0%d" % (i % 3 + 1), None if i == 9 else f"ü{i}\"", i) for i in range(20)],
                                 "day string, user_id string, n int")
    by_text, by_col = os.path.join(tmpdir_path, "a"), os.path.join(tmpdir_path, "b")
    jobs.land_documents(rows, by_col, "sessions")
    lines = rows.select(F.col("day").cast("date").alias("day"), F.lit("sessions").alias("dataset"),
                        lake.json_line(["user_id", "n"]).alias("value"))
    lake.write_sharded_jsonl(lines, by_text)
    asked = [None, "ü3\"", "ü10\"", "ü19\""]
    for users in (None, *[[u] for u in asked[1:]]):
        a, b = (sorted(r.value for r in lake.scan_jsonl(spark, root, users=users).collect()) for root in (by_text, by_col))
        assert a == b and len(a) == (20 if users is None else 1)
    assert [d.day for d in lake.days_held(spark, by_col)] == [1, 2, 3]
    lake.write_prefix(spark.createDataFrame([], "value string"), by_col, {"day": "2024-01-03", "dataset": "sessions"})
    assert [d.day for d in lake.days_held(spark, by_col, "sessions")] == [1, 2]
    plan = rows.sparkSession._jvm.PythonSQLUtils.explainString(
        landed.aggregated_documents(standins.read_events(spark, "/root/testdata/sf0.001"))._jdf.queryExecution(), "simple")
    assert plan.count("Exchange hashpartitioning") == 1


def test_elements_land_with_the_documents_text(spark):
    """Plain elements keep their text of the document; where it could differ
    from what their VARIANT writes, that is written as before."""
    plain = ['{"session": [{"b": {"y": 1, "x": [2, null]}, "a": -71.4000015258789, "user_id": "z"}, {"s": "\\ud83d\\ude00\\n"}]}',
             "{'session': [{'a': 'x\"y'}, 3, \"q\", null, true, [1], {}, {\"activityType\": 72}]}",
             '{"session": [{"a": 1, "a": 2}]}', '{"session": {"a": 1}}', '{"session": [{"a": 1e5, "b": 1E400, "c": -0}]}',
             '{"session": [{"v": "1.2.30", "n": 123456789012345678901234567890}]}', '{"session": []}']
    odd = ['{"session": [{"a": 0.12345678901234567890123}]}', '{"session": [{"a": 12345678901234567.25}]}',
           '{"session": [{"a": 72.0}, {"a":0.0001}]}', '{"session": [{"a": 100000000.5}]}',
           '{"session": ["{\\"a\\":1}", {"b": 1}]}', '{"session": ["\\u007b}"]}']
    docs = landing.parsed_once(_docs(spark, *plain, *odd), landing.SESSIONS_RAW)
    texts = {r[0]: r[1] for r in docs.select(landing.TEXT, F.col(landing.TEXTS).isNotNull()).collect()}
    assert texts == {**dict.fromkeys(plain, True), **dict.fromkeys(odd, False)}

    def lines(docs):
        rows = landing.session_lines(landing.marked_documents(docs, ["session"]), user_col="__user")
        return sorted(((r[landing.REASON] or "", json.dumps(json.loads(r.value), sort_keys=True))
                       if r.value and r[landing.REASON] != "document" else (r[landing.REASON] or "", r.value or "")
                       for r in rows.collect()))

    assert lines(docs) == lines(docs.drop(landing.TEXTS))
    point = '{"a": 1.5, "value": [{"fpVal": 29.27}]}'
    nested = f'{{"bucket": [{{"startTimeMillis": "1", "dataset": [{{"point": [{point}, {point}]}}, {{"point": []}}]}}, null]}}'
    docs = landing.parsed_once(_docs(spark, nested), landing.AGGREGATED_RAW)
    for d in (docs, docs.drop(landing.TEXTS)):
        rows = landing.aggregated_lines(d, user_col="__user").collect()
        assert [json.loads(r.value) for r in rows] == [{"user_id": "u1", "startTimeMillis": "1", **json.loads(point)}] * 2


def test_fitness_datasets_land_at_the_same_time(spark, monkeypatch):
    """All four landings of the query are under way together."""
    met, land = threading.Barrier(4, timeout=120), jobs.land_answers

    def together(*args, **kwargs):
        met.wait()
        return land(*args, **kwargs)

    monkeypatch.setattr(jobs, "land_answers", together)
    _, rejects = catalog_io._land_all(spark, "/root/testdata/sf0.001")
    assert {r.dataset for r in rejects.select("dataset").distinct().collect()} == {
        "sessions", "aggregated-datasets", "datasources", "datasets"}


def _plan(df):
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")


def test_sessions_are_made_where_their_events_are_dealt(spark):
    """Of an event only its own columns cross the one exchange; the documents
    are the same, however many tasks make them."""
    events = standins.read_events(spark, "/root/testdata/sf0.001").withColumns({
        "event_type": F.when(F.col("event_id") % 7 == 0, F.lit('a"\\ü\n')).otherwise(F.col("event_type")),
        "value": F.when(F.col("event_id") % 5 != 0, F.col("value"))})

    def made(tasks):
        docs = landed.session_documents(events, tasks).collect()
        return sorted((r.user_id, r.page, sorted(json.dumps(s, sort_keys=True) for s in json.loads(r.value)["session"]))
                      for r in docs)

    assert made(3) == made(None) and sum(len(r[2]) for r in made(3)) == events.count()
    sessions = [json.loads(s) for r in made(3) for s in r[2]]
    assert {s["name"] for s in sessions} > {'a"\\ü\n'}
    assert {("endTimeMillis" in s) == (int(s["id"]) % 5 != 0) for s in sessions} == {True}
    plan = _plan(landed.session_documents(events, 3))
    assert plan.count("Exchange") == 1 and "Aggregate" not in plan[plan.index("Exchange"):]
    assert landed.document_tasks(events) == spark.sparkContext.defaultParallelism


def test_user_of_a_line_is_the_one_that_its_text_tells(spark):
    """Lines that begin with the user are not parsed for it; all others are."""
    lines = ['{"user_id":"u1","a":1}', '{"user_id":"u1"}', '{"user_id":"ü 1","user_id":"b"}', '{"user_id":""}',
             '{"user_id":"a\\"b","c":1}', '{"user_id":"\\u0041"}', '{"user_id":null}', '{"user_id":5}', '{"user_id": "u1"}',
             '{"a":1,"user_id":"u2"}', '{"a":{"user_id":"u3"}}', '{"user_id":"u1","a":', '{"user_id":"u1"', '{"user_id":"u1"x}',
             '{"user_id":"a\tb"}', '{"user_id":{"user_id":"u1"}}', '["user_id"]', "u1", "", None]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    got = df.select("value", lake._user(F.col("value")).alias("own"), F.get_json_object("value", "$.user_id").alias("all"))
    assert [(r.value, r.own) for r in got.collect()] == [(r.value, r.all) for r in got.collect()]
    assert "regexp_extract" in _plan(got)


def test_kept_lines_do_not_move_to_meet_a_few_users(spark):
    """Lines that a landing keeps are dealt out once, for the write; for users
    beyond a broadcast by a shuffle join.  Both keep the same lines."""
    held = spark.createDataFrame([(i % 8, json.dumps({"user_id": f"u{i}"}, separators=(",", ":"))) for i in range(100)]
                                 + [(0, '{"a":1}'), (0, "broken")], "bucket int, value string")
    users = spark.createDataFrame([(f"u{i}",) for i in range(0, 200, 2)] + [("broken",)], "__user string")
    few, many = lake._kept(held, users, 101 * 70), lake._kept(held, users, 1 << 40)
    plan = _plan(few)
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
    want = sorted([json.dumps({"user_id": f"u{i}"}, separators=(",", ":")) for i in range(1, 100, 2)] + ['{"a":1}', "broken"])
    assert sorted(r.value for r in few.collect()) == want == sorted(r.value for r in many.collect())
