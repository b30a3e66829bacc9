"""Flatten/project against a brute-force Python flattener on random lines."""

import json
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from daycut.operators import flatten

TARGET = T.StructType([T.StructField("a_b", T.LongType()), T.StructField("c", T.StringType()),
                       T.StructField("d0_e1_f", T.DoubleType()),
                       T.StructField("ts", T.LongType())])


def brute_flatten(obj, drop_chars):
    """Every leaf path → normalised name; later keys overwrite earlier ones."""
    out = {}

    def walk(v, path):
        if isinstance(v, dict):
            for k, x in v.items():
                walk(x, f"{path}.{k}" if path else k)
        elif isinstance(v, list):
            for i, x in enumerate(v):
                walk(x, f"{path}[{i}]")
        else:
            name = path.replace(".", "_")
            if drop_chars:
                name = re.sub("[" + re.escape(drop_chars) + "]", "", name)
            out[name] = v
    walk(obj, "")
    return out


def expected_row(obj, drop_chars):
    flat = brute_flatten(obj, drop_chars)
    row, bad = {}, False
    for f in TARGET.fields:
        v = flat.get(f.name)
        if v is None:
            row[f.name] = None
            continue
        s = v if isinstance(v, str) else json.dumps(v)
        if isinstance(f.dataType, T.LongType):
            if isinstance(v, bool) or not re.fullmatch(r"\s*[+-]?[0-9]+\s*", s):
                bad = True
                row[f.name] = None
            else:
                row[f.name] = int(s)
        elif isinstance(f.dataType, T.DoubleType):
            try:
                row[f.name] = float(s)
            except ValueError:
                bad, row[f.name] = True, None
        else:
            row[f.name] = s
    return row, bad


flat_keys = st.sampled_from(["a_b", "a.b", "c", "c(", "(c)", "ts", "t(s)", "x"])
flat_values = st.one_of(st.none(), st.integers(-10**6, 10**6),
                        st.sampled_from(["7", "-3", "1.5", "abc", " 12 "]))
flat_objects = st.dictionaries(flat_keys, flat_values, max_size=6)


@settings(max_examples=15, deadline=None)
@given(st.lists(flat_objects, min_size=1, max_size=8))
def test_flat_mode_matches_bruteforce(spark, objs):
    lines = [json.dumps(o) for o in objs]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(lines)], "i long, value string")
    rows = flatten.flatten_project(df, TARGET, drop_chars=flatten.BRACKETS_AND_PARENS,
                                   keep=["i"]).collect()
    got = {r.i: r for r in rows}
    for i, o in enumerate(objs):
        # json.loads keeps the last of duplicate keys, as the map parse does
        want, bad = expected_row(json.loads(lines[i]), flatten.BRACKETS_AND_PARENS)
        r = got[i]
        assert (r[flatten.REASON] is not None) == bad, (o, r)
        for f in TARGET.fields:
            assert r[f.name] == want[f.name], (f.name, o, r)


NESTED = T.StructType([
    T.StructField("a", T.StructType([T.StructField("b", T.LongType())])),
    T.StructField("c", T.StringType()),
    T.StructField("d", T.ArrayType(T.StructType([
        T.StructField("e", T.ArrayType(T.StructType([T.StructField("f", T.DoubleType())])))]))),
    T.StructField("ts", T.StringType()),
])
nested_objects = st.fixed_dictionaries({}, optional={
    "a": st.fixed_dictionaries({}, optional={"b": st.integers(-100, 100)}),
    "c": st.text("xyz", max_size=3),
    "d": st.lists(st.fixed_dictionaries({}, optional={
        "e": st.lists(st.fixed_dictionaries({}, optional={"f": st.floats(-5, 5, width=32)}),
                      max_size=2)}), max_size=2),
    "ts": st.sampled_from(["1", "2x", "30"]),
})


@settings(max_examples=15, deadline=None)
@given(st.lists(nested_objects, min_size=1, max_size=8))
def test_nested_mode_matches_bruteforce(spark, objs):
    lines = [json.dumps(o) for o in objs]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(lines)], "i long, value string")
    rows = flatten.flatten_project(df, TARGET, input_schema=NESTED, keep=["i"]).collect()
    got = {r.i: r for r in rows}
    for i, o in enumerate(objs):
        want, bad = expected_row(o, flatten.BRACKETS)
        r = got[i]
        assert (r[flatten.REASON] is not None) == bad, (o, r)
        for f in TARGET.fields:
            assert r[f.name] == want[f.name], (f.name, o, r)
