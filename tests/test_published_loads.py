"""Lake and warehouse loads: user-level replace, atomic days, one parse, named
tables, clean-up."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daycut.plans import jobs
from daycut.sinks import lake, published, warehouse
from daycut.sources import landing

DAY = "2024-01-09"


def answers(spark, *pairs):
    rows = [(u, json.dumps({"session": [{"id": i} for i in ids]})) for u, *ids in pairs]
    docs = spark.createDataFrame(rows, f"__user string, {landing.TEXT} string")
    return landing.parsed_once(docs, landing.SESSIONS_RAW)


def land(spark, root, *pairs, day=DAY):
    jobs.land_answers(answers(spark, *pairs), "sessions", root, day, user_col="__user")


def held(spark, root, **kw):
    rows = lake.scan_jsonl(spark, root, **kw).collect()
    return sorted((json.loads(r.value)["user_id"], json.loads(r.value)["id"]) for r in rows)


def test_landings_of_different_users_keep_both(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "lake")
    land(spark, root, ("u1", "a"), ("u2", "b"))
    land(spark, root, ("u3", "c"), ("u2", "b2", "b3"))
    assert held(spark, root) == [("u1", "a"), ("u2", "b2"), ("u2", "b3"), ("u3", "c")]
    # a single-user run shares the root; replacing by nothing drops that user only
    jobs.land_answers(answers(spark, ("u1",)), "sessions", root, DAY, user_id="u1")
    assert held(spark, root) == [("u2", "b2"), ("u2", "b3"), ("u3", "c")]
    land(spark, root, ("u1", "x"), day="2024-01-10")
    assert held(spark, root, users=["u1"]) == [("u1", "x")]
    assert held(spark, root, day=DAY, users=["u2"]) == [("u2", "b2"), ("u2", "b3")]
    assert held(spark, root, day=[DAY, "2024-01-10"], dataset="sessions")[0] == ("u1", "x")
    assert held(spark, root, dataset="other") == []


def test_single_user_landing_rewrites_one_bucket(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "lake")
    land(spark, root, *[(f"u{i}", f"s{i}") for i in range(40)])
    before = {s.bucket: s.load for s in published.current(spark, root)}
    land(spark, root, ("u7", "new"))
    after = {s.bucket: s.load for s in published.current(spark, root)}
    assert sum(before.get(b) != after[b] for b in after) == 1
    assert len(held(spark, root)) == 40 and ("u7", "new") in held(spark, root)


def test_merge_is_done_anew_when_overtaken(spark, tmpdir_path, monkeypatch):
    root = os.path.join(tmpdir_path, "lake")
    land(spark, root, ("u1", "a"))
    write, calls = lake._write, []

    def overtaken(lines, where, load, shards):
        found = write(lines, where, load, shards)
        if not calls:                           # another landing of the same bucket comes first
            calls.append(load)
            land(spark, where, ("u1", "b"))
        return found

    monkeypatch.setattr(lake, "_write", overtaken)
    lake.write_users(spark.createDataFrame([('{"user_id":"u1","id":"c"}',)], "value string"), root, DAY, "sessions",
                     spark.createDataFrame([("u1",)], "user string"))
    assert held(spark, root) == [("u1", "c")] and not os.path.exists(published.load_path(root, calls[0]))


def rows(spark, *r):
    return spark.createDataFrame(list(r), "user_id string, t long, day string").withColumn("day", F.col("day").cast("date"))


def read(spark, table, **kw):
    return sorted((r.user_id, r.t, str(r.day)) for r in warehouse.read_table(spark, table, **kw).collect())


def test_failed_load_leaves_the_old_day(spark, tmpdir_path):
    table = os.path.join(tmpdir_path, "t")
    warehouse.load_days(rows(spark, ("a", 1, DAY), ("b", 2, "2024-01-10")), table, [DAY, "2024-01-10"])
    want = read(spark, table)
    bad = rows(spark, *[("c", i, DAY) for i in range(50)]).repartition(5).withColumn(
        "t", F.when(F.col("t") == 49, F.raise_error(F.lit("stop")).cast("long")).otherwise(F.col("t")))
    with pytest.raises(Exception, match="stop"):
        warehouse.load_days(bad, table, [DAY], cluster_by=["user_id", "t"])
    assert read(spark, table) == want
    frame = warehouse.read_table(spark, table)          # a reader keeps what it started with
    warehouse.load_partition(rows(spark, ("d", 4, DAY)).drop("day"), table, DAY)
    assert read(spark, table) == [("b", 2, "2024-01-10"), ("d", 4, DAY)]
    assert sorted(r.user_id for r in frame.collect()) == ["a", "b"]
    assert read(spark, table, days=[DAY]) == [("d", 4, DAY)]


def test_expire_deletes_replaced_loads(spark, tmpdir_path):
    table = os.path.join(tmpdir_path, "t")
    for i in range(3):
        warehouse.load_partition(rows(spark, ("a", i, DAY)).drop("day"), table, DAY)
    assert published.expire(spark, table) == []                         # too young
    assert len(os.listdir(os.path.join(table, published.LISTS))) >= 1
    assert len(published.expire(spark, table, dt.timedelta(0))) == 2
    assert read(spark, table) == [("a", 2, DAY)]
    assert published.expire(spark, os.path.join(tmpdir_path, "none")) == []


def test_new_column_reads_null_in_old_loads(spark, tmpdir_path):
    table = os.path.join(tmpdir_path, "t")
    warehouse.load_partition(rows(spark, ("a", 1, DAY)).drop("day"), table, DAY)
    wide = rows(spark, ("b", 2, DAY)).drop("day").withColumn("extra", F.lit("x"))
    warehouse.load_partition(wide, table, "2024-01-10")
    got = {(r.user_id, r.extra) for r in warehouse.read_table(spark, table).collect()}
    assert got == {("a", None), ("b", "x")}


TRACKED = [{"user_id": "u1", "date_timestamp_millis": "1704790800000", "time_spent_(seconds)": "60", "productivity": "2"},
           {"user_id": "u2", "date_timestamp_millis": "1704790800000", "time_spent_seconds": "5", "productivity": "9"},
           {"user_id": "u3", "date_timestamp_millis": "x"}]
SESSION = {"user_id": "u1", "id": "s", "startTimeMillis": "1704754800000", "endTimeMillis": "1704762000000", "activityType": 72}


def fill_lake(spark, root):
    lines = [("time-tracking", json.dumps(x)) for x in TRACKED] + [("time-tracking", "{broken"), ("sessions", json.dumps(SESSION))]
    lake.write_sharded_jsonl(spark.createDataFrame([(DAY, *x) for x in lines], "day string, dataset string, value string")
                             .withColumn("day", F.col("day").cast("date")), root)


def test_counts_and_rejects_without_asking(spark, tmpdir_path):
    root, table = os.path.join(tmpdir_path, "lake"), os.path.join(tmpdir_path, "tt")
    fill_lake(spark, root)
    assert jobs.job_load_time_tracking(spark, root, table, jobs.day_window(DAY)) == jobs.Counts(1, 3)
    bad = warehouse.read_table(spark, warehouse.rejects_of(table, None, "time-tracking"))
    assert sorted(r.reason for r in bad.collect()) == ["bad bigint: date_timestamp_millis", "bad productivity code",
                                                       "not a JSON object"]
    # a re-run replaces the day's rejects too
    jobs.job_load_time_tracking(spark, root, table, jobs.day_window(DAY))
    assert warehouse.read_table(spark, f"{table}_rejects").count() == 3


def test_a_load_scans_and_parses_once(spark, tmpdir_path, monkeypatch):
    """One job of the whole load reads the lake's lines, and parses them once."""
    root, table = os.path.join(tmpdir_path, "lake"), os.path.join(tmpdir_path, "tt")
    fill_lake(spark, root)
    parsed = spark.sparkContext.accumulator(0)
    make = jobs.PARSED["time_tracking"]
    plans = []

    @F.udf(T.StringType())
    def seen(value):
        parsed.add(1)
        return value

    def counted(lines, target):
        out = make(lines.withColumn("value", seen("value")), target)
        plans.append(out._jdf.queryExecution().optimizedPlan().toString())
        return out

    monkeypatch.setitem(jobs.PARSED, "time_tracking", counted)
    jobs.job_load_time_tracking(spark, root, table, jobs.day_window(DAY))
    assert parsed.value == 4                    # each line went through the parse's plan once
    assert len(plans) == 1 and plans[0].count("Relation [value") == 1


def test_reload_into_named_tables(spark, tmpdir_path):
    """Loads and reloads by table name, statistics included."""
    root, tag = os.path.join(tmpdir_path, "lake"), os.path.basename(tmpdir_path).replace("-", "_").lower()
    spark.sql(f"CREATE DATABASE {tag} LOCATION '{tmpdir_path}/db'")
    try:
        fill_lake(spark, root)
        tables = {k: f"{tag}.{k}" for k in ("points", "sessions", "time_tracking")}
        counts = jobs.run_reload(spark, "2024-01-09", root, tables, f"{tag}.rejects")
        assert counts["time_tracking"] == jobs.Counts(1, 3) and counts["points"] == jobs.Counts(0, 0)
        jobs.run_reload(spark, "2024-01-10", root, tables, f"{tag}.rejects")        # the 9th again, and an empty day
        assert warehouse.read_table(spark, tables["time_tracking"]).count() == 1
        assert spark.table(f"{tag}.rejects_time_tracking").count() == 3
        assert warehouse.read_table(spark, tables["sessions"], [DAY]).count() >= 1
        assert spark.table(tables["points"]).count() == 0
        stats = spark.sql(f"DESCRIBE EXTENDED {tables['time_tracking']} PARTITION (day = DATE'{DAY}')").collect()
        assert any("1 rows" in (r.data_type or "") for r in stats)
        # the day is landed anew without lines: the next load empties it
        lake.write_prefix(spark.createDataFrame([], "value string"), root, {"day": DAY, "dataset": "time-tracking"})
        jobs.job_load_time_tracking(spark, root, tables["time_tracking"], jobs.day_window(DAY))
        assert spark.table(tables["time_tracking"]).count() == 0
    finally:
        spark.sql(f"DROP DATABASE {tag} CASCADE")
