"""Flatten, projection, coercion, productivity rule and rejects (FIXTURES §2)."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daycut.operators import flatten
from daycut.plans import jobs
from daycut.sources import schema


def _lines(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def test_point_line(spark):
    line = json.dumps({"user_id": "u1", "dataSourceId": "d",
                       "startTimeNanos": "1591401600000000000",
                       "endTimeNanos": "1591403400000000000",
                       "dataTypeName": "com.google.step_count.delta",
                       "value": [{"intVal": 42}], "unknownKey": 5})
    good, rejects = jobs.point_rows(_lines(spark, [line]))
    r = good.collect()[0]
    assert r.value0_intVal == 42 and r.value0_fpVal is None
    assert r.startTimeNanos == 1591401600000000000 and r.user_id == "u1"
    assert good.columns == [f.name for f in schema.AGGREGATED_DATASETS.fields]
    assert rejects.count() == 0


def test_session_line_nested_name(spark):
    line = json.dumps({"user_id": "u1", "id": "s1", "startTimeMillis": "1000",
                       "endTimeMillis": "2000", "application": {"packageName": "p"},
                       "activityType": 72})
    good, _ = jobs.session_rows(_lines(spark, [line]))
    r = good.collect()[0]
    assert r.application_packageName == "p" and r.activityType == 72
    assert (r.startTimeMillis, r.endTimeMillis) == (1000, 2000)


def test_activity_line(spark):
    line = json.dumps({"user_id": "u1", "date": "2020-05-16T09:00:00",
                       "date_timestamp_millis": "1589587200000",
                       "time_spent_(seconds)": "60", "activity": "mail",
                       "category": "Mail", "productivity": "-1"})
    good, rejects = jobs.time_tracking_rows(_lines(spark, [line]))
    r = good.collect()[0]
    assert r.time_spent_seconds == 60 and r.productivity == -1
    assert r.productivity_string == "distracting"
    assert "date" not in good.columns
    assert rejects.count() == 0


def test_bad_lines_rejected(spark):
    base = {"user_id": "u1", "activity": "x"}
    bad = ["", "notjson", "[1, 2]",
           json.dumps({**base, "productivity": "3"}),
           json.dumps({**base, "productivity": "x"}),
           json.dumps({**base, "productivity": None}),
           json.dumps({**base, "productivity": "1.5"}),
           json.dumps({**base, "time_spent_(seconds)": "abc"})]
    good, rejects = jobs.time_tracking_rows(_lines(spark, bad))
    g2, r2 = jobs.time_tracking_rows(_lines(spark, bad), any_key_spelling=True)
    assert g2.count() == 0 and r2.count() == len(bad)
    assert good.count() == 0
    reasons = [r.reason for r in rejects.collect()]
    assert len(reasons) == len(bad) and all(reasons)


def test_edge_lines_kept(spark):
    lines = [json.dumps({"user_id": "u1", "activity": "x"}),       # no productivity key
             json.dumps({"somethingElse": 1})]                      # unknown key only
    good, rejects = jobs.time_tracking_rows(_lines(spark, lines))
    rows = good.collect()
    assert len(rows) == 2 and rejects.count() == 0
    assert all(r.productivity_string is None for r in rows)
    assert any(all(v is None for v in r.asDict().values()) for r in rows)


def test_last_write_wins_on_equal_names(spark):
    line = '{"time_spent_(seconds)": "1", "time_spent_seconds": "2"}'
    for generic in (False, True):
        good, _ = jobs.time_tracking_rows(_lines(spark, [line]), any_key_spelling=generic)
        assert good.collect()[0].time_spent_seconds == 2


@pytest.mark.parametrize("name,drop,want", [
    ("value[0].fpVal", flatten.BRACKETS, "value0_fpVal"),
    ("application.packageName", flatten.BRACKETS, "application_packageName"),
    ("time_spent_(seconds)", flatten.BRACKETS_AND_PARENS, "time_spent_seconds"),
    ("time_spent_(seconds)", flatten.BRACKETS, "time_spent_(seconds)"),
])
def test_normalise(name, drop, want):
    assert flatten.normalise(name, drop) == want


def test_schema_file_roundtrip(tmp_path):
    p = tmp_path / "s.json"
    p.write_text(schema.schema_json("data", schema.TIME_TRACKING_FIELDS))
    assert schema.load_schema(str(p)) == schema.TIME_TRACKING
    with pytest.raises(schema.SchemaError):
        schema.load_schema(str(tmp_path / "missing.json"))
    bad = tmp_path / "bad.json"
    bad.write_text("{not json")
    with pytest.raises(schema.SchemaError):
        schema.load_schema(str(bad))


def test_declared_and_generic_time_tracking_agree(spark):
    lines = [json.dumps(o) for o in (
        {"user_id": "u", "time_spent_(seconds)": "5", "productivity": 1},
        {"user_id": "u", "time_spent_seconds": "6", "productivity": None},
        {"user_id": "u", "activity": "x"},
        {"user_id": "u", "productivity": "2", "category": "c", "date": "2024-01-01T00:00:00"})]
    a, ra = jobs.time_tracking_rows(_lines(spark, lines))
    b, rb = jobs.time_tracking_rows(_lines(spark, lines), any_key_spelling=True)
    assert sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))
    assert sorted(r.reason for r in ra.collect()) == sorted(r.reason for r in rb.collect()) \
        == ["bad productivity code"]


def test_path_dictionary(spark):
    lines = [{"device": {"uid": 1, "a'b": {'c"d': 2}}, "device_uid": 3}, {"v": [[0, 1, [5, 6]], 9], "v12": 1, "v1": [7]},
             {"a": {"b": {"c": {"d": {"e": {"f": {"g": {"h": {"i": {"j": {"k": 1}}}}}}}}}}}, {"x.y": {"z[0]": [{"": 4}]}},
             {"device": {"uid": {"deeper": 1}}}]
    df = spark.createDataFrame([(json.dumps(x),) for x in lines] + [("{broken",), (None,), ("5",)], "value string")
    wanted = {"device_uid", "v02", "v12", "a_b_c_d_e_f_g_h_i_j_k", "x_y_z00_", "device_a'b_c\"d", "no_such"}
    got = flatten.path_dictionary(df, wanted)
    assert got == {"device_uid": [("device_uid",), ("device", "uid")], "v12": [("v12",)],
                   "a_b_c_d_e_f_g_h_i_j_k": [tuple("abcdefghijk")], "x_y_z00_": [("x.y", "z[0]", 0, "")],
                   "device_a'b_c\"d": [("device", "a'b", 'c"d')]}
    assert flatten.merge_dictionaries(got, {"v12": [("v", 1, 2), ("v12",)]})["v12"] == [("v12",), ("v", 1, 2)]
    target = T.StructType([T.StructField(n, T.LongType()) for n in sorted(wanted)])
    rows = flatten.flatten_project(df.limit(4), target, input_schema=T.StructType([T.StructField("other", T.StringType())]))
    first = [[r[n] for r in rows.collect() if r[n] is not None] for n in ("device_uid", "a_b_c_d_e_f_g_h_i_j_k", "x_y_z00_",
                                                                          "device_a'b_c\"d", "no_such")]
    assert first == [[3], [1], [4], [2], []]
    # a known dictionary saves the pass
    again = flatten.flatten_project(df.limit(4), target, input_schema=T.StructType([T.StructField("other", T.StringType())]), paths=got)
    assert sorted(map(str, again.collect())) == sorted(map(str, rows.collect()))


def test_undeclared_nested_paths(spark):
    target = schema.struct_from_fields([("user_id", "STRING"), ("device_uid", "STRING"), ("value0_fpVal", "FLOAT64"),
                                        ("more1_x", "INT64"), ("device", "STRING")])
    lines = ['{"user_id":"a","device":{"uid":"u1"},"value":[{"fpVal":1.5}],"more":[{"x":1},{"x":2}]}',
             '{"user_id":"b","device_uid":"flat","device":{"uid":"nested"}}',
             '{"user_id":"c","more":[{"x":1},{"x":"no number"}]}',
             '{"user_id":"d","device":{"uid":null},"more":[{"x":1}]}', '{"user_id":"e","device":"plain"}',
             '{"user_id":"f","device":{"uid":"1","uid":"2"}}']
    declared = T.StructType([T.StructField("user_id", T.StringType())])
    rows = flatten.flatten_project(_lines(spark, lines), target, input_schema=declared)
    good, rejects = flatten.split_rejects(rows)
    assert {tuple(r) for r in good.collect()} == {
        ("a", "u1", 1.5, 2, None), ("b", "flat", None, None, None), ("d", None, None, None, None),
        ("e", None, None, None, "plain")}
    assert sorted(r.reason for r in rejects.collect()) == ["bad bigint: more1_x", "not readable for undeclared columns"]
    flat = flatten.flatten_project(_lines(spark, lines[:2]), T.StructType(target.fields[:4]))
    got = {tuple(r) for r in flatten.split_rejects(flat)[0].collect()}
    assert got == {("a", "u1", 1.5, 2), ("b", "flat", None, None)}


def test_schema_file_decides_the_columns(spark, tmp_path):
    p = tmp_path / "s.json"
    p.write_text(schema.schema_json("t", [("user_id", "STRING"), ("device_uid", "STRING")]))
    rows, _ = jobs.point_rows(_lines(spark, ['{"user_id":"a","device":{"uid":"u1"}}']), f"file://{p}")
    assert [tuple(r) for r in rows.collect()] == [("a", "u1")]
    with pytest.raises(schema.SchemaError):
        jobs.point_rows(_lines(spark, []), f"file://{tmp_path}/none.json")
    with pytest.raises(schema.SchemaError):                       # the split needs both times
        jobs.session_rows(_lines(spark, []), target=f"file://{p}")
    rows, _ = jobs.time_tracking_rows(_lines(spark, ['{"user_id":"a","productivity":"9"}']), target=f"file://{p}")
    assert [tuple(r) for r in rows.collect()] == [("a", None)]


def test_text_window():
    w = jobs.text_window("2024-01-09T00:00:00Z", "2024-01-09T23:59:59.99Z")
    d = jobs.day_window("2024-01-09")
    assert (w.day, w.begin_ms, w.end_ms) == (d.day, d.begin_ms, d.end_ms - 10)
    assert jobs.text_window("2024-01-09T01:00:00+09:00", "2024-01-10T00:00:00Z").day.isoformat() == "2024-01-08"
    with pytest.raises(ValueError):
        jobs.text_window("2024-01-09T00:00:00", "2024-01-10T00:00:00Z")


def test_paths_are_found_on_distinct_shapes(spark):
    """However many lines there are, the paths of each shape are looked for once."""
    lines = [f'{{"a":{{"b":[{i},"x\\"{i}"]}},"k{i % 2}":{{"c d":-{i}.5e3}}, "t":null, "":true}}' for i in range(40)]
    odd = ['{"a":01}', '{"a":1.5.5}', '{"a":"x""y"}', '{"z":\x01}', '{"z":"\\q"}', '{"z":tru}', '[1]', '', 'x']
    shapes = [r[0] for r in _lines(spark, lines + odd).select(flatten.shape(F.col("value"))).distinct().collect()]
    assert sorted(s for s in shapes if s.startswith('{"a":{')) == [
        '{"a":{"b":[0,""]},"k0":{"c d":0}, "t":0, "":0}', '{"a":{"b":[0,""]},"k1":{"c d":0}, "t":0, "":0}']
    bad = spark.createDataFrame([(s,) for s in shapes], "value string")
    assert bad.where("try_parse_json(value) IS NOT NULL").count() == 3          # the two above and [1]
    assert flatten.path_dictionary(_lines(spark, lines + odd), {"a_b1", "k1_c d", "z", "t"}) == {
        "a_b1": [("a", "b", 1)], "k1_c d": [("k1", "c d")], "t": [("t",)]}
