"""Landing: API answers (one nested JSON document each) → flat-ish rows.

Every parser is ``explode`` + ``select`` over a DataFrame with one row per
document, so a read of many users' files is one distributed job.  The user id
comes either as a literal (one user per run) or from a column (for instance a
``user_id=…`` directory of the landing path).  Documents that miss a required
part go to rejects instead of failing the whole import.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daycut.functions import labels, timez
from daycut.operators.rows import computed

S = T.StringType()

POINT = T.StructType([
    T.StructField("startTimeNanos", S), T.StructField("endTimeNanos", S),
    T.StructField("dataTypeName", S), T.StructField("originDataSourceId", S),
    T.StructField("modifiedTimeMillis", S),
    T.StructField("value", T.ArrayType(T.StructType([
        T.StructField("fpVal", T.DoubleType()), T.StructField("intVal", T.LongType()),
        T.StructField("stringVal", S)]))),
])

SESSIONS_ENVELOPE = T.StructType([T.StructField("session", T.ArrayType(T.StructType([
    T.StructField("id", S), T.StructField("name", S), T.StructField("description", S),
    T.StructField("startTimeMillis", S), T.StructField("endTimeMillis", S),
    T.StructField("modifiedTimeMillis", S),
    T.StructField("application", T.StructType([T.StructField("packageName", S)])),
    T.StructField("activityType", T.LongType()),
])))])

DATASOURCES_ENVELOPE = T.StructType([T.StructField("dataSource", T.ArrayType(T.StructType([
    T.StructField("dataStreamId", S), T.StructField("dataStreamName", S),
    T.StructField("type", S),
])))])

DATASETS_ENVELOPE = T.StructType([
    T.StructField("minStartTimeNs", S), T.StructField("maxEndTimeNs", S),
    T.StructField("dataSourceId", S), T.StructField("point", T.ArrayType(POINT)),
])

AGGREGATED_ENVELOPE = T.StructType([T.StructField("bucket", T.ArrayType(T.StructType([
    T.StructField("startTimeMillis", S), T.StructField("endTimeMillis", S),
    T.StructField("dataset", T.ArrayType(T.StructType([
        T.StructField("dataSourceId", S), T.StructField("point", T.ArrayType(POINT))]))),
])))])

MATRIX_ENVELOPE = T.StructType([
    T.StructField("row_headers", T.ArrayType(S)),
    T.StructField("rows", T.ArrayType(T.ArrayType(S))),
])

# The same envelopes down to their elements only: what lands in the lake keeps
# every key of an element, also those that no schema here names.
V = T.VariantType()

SESSIONS_RAW = T.StructType([T.StructField("session", T.ArrayType(V))])

DATASOURCES_RAW = T.StructType([T.StructField("dataSource", T.ArrayType(V))])

DATASETS_RAW = T.StructType([
    T.StructField("minStartTimeNs", S), T.StructField("maxEndTimeNs", S),
    T.StructField("dataSourceId", S), T.StructField("point", T.ArrayType(V)),
])

AGGREGATED_RAW = T.StructType([T.StructField("bucket", T.ArrayType(T.StructType([
    T.StructField("startTimeMillis", S), T.StructField("endTimeMillis", S),
    T.StructField("dataset", T.ArrayType(T.StructType([
        T.StructField("dataSourceId", S), T.StructField("point", T.ArrayType(V))]))),
])))])

REASON = "_reject_reason"
TEXT = "_text"
TEXTS = "__texts"

# Of a document, numbers that a double need not give back digit by digit: the
# text of its elements may differ from what their VARIANT writes.
_ODD_NUMBER = (r"\.(?<=[0-9]\.)(?=[0-9]++\s*+[,\]}])"
               r"(?:(?!(?:[0-9]{0,7}|(?<![0-9]{3}\.)[0-9]{0,12})[1-9]\s*+[,\]}])|(?<=[0-9]{8}\.)|(?<=[^0-9]0\.)000)")


def _as_text(kind: T.DataType) -> T.DataType:
    """The same shape with text in the place of VARIANT."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _as_text(f.dataType)) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_as_text(kind.elementType))
    return S if isinstance(kind, T.VariantType) else kind


def read_envelopes(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """One row per file: the envelope, and the file's name (for the
    path-derived user) and whole text (for rejects)."""
    raw = spark.read.text(path, wholetext=True) \
        .select(F.col("_metadata.file_path").alias("_file"), F.col("value").alias(TEXT))
    return parsed_once(raw, schema)


def parsed_once(docs: DataFrame, schema: T.StructType, text_col: str = TEXT) -> DataFrame:
    """``docs`` with the envelope's columns; each document is parsed once,
    however many filters follow.

    An envelope with VARIANT elements is also read with their text (``__texts``,
    null where that could differ): the VARIANT tells what is valid and what an
    element holds, but costs several times a parse to be written as text again.
    """
    full = T.StructType(list(schema.fields) + [T.StructField("_corrupt_record", S)])
    keep, text = docs.columns, F.col(text_col)
    cols = [*[F.col(c) for c in keep], F.from_json(text, full).alias("__d")]
    if _as_text(schema) == schema:
        return computed(docs, cols).select(*keep, "__d.*")
    # a text element that looks like an object is none
    odd = text.contains('"{') | text.contains("'{") | text.contains("u007") \
        | (text.contains(".") & text.rlike(_ODD_NUMBER))
    cols.append(F.when(~odd, F.from_json(text, _as_text(schema))).alias(TEXTS))
    return computed(docs, cols).select(*keep, "__d.*", TEXTS)


def user_from_path(path_col: str = "_file", key: str = "user") -> Column:
    """User id from a ``…/<key>=<id>/…`` folder of the file path."""
    raw = F.regexp_extract(F.col(path_col), f"/{key}=([^/]+)/", 1)
    # paths are URI-encoded, but a plus sign is a plus sign
    return F.coalesce(F.try_url_decode(F.replace(raw, F.lit("+"), F.lit("%2B"))), raw)


def envelopes_from_text(df: DataFrame, schema: T.StructType, text_col: str = "value",
                        keep: list[str] | None = None) -> DataFrame:
    """Documents held as text in a column → parsed envelope columns."""
    keep = keep or []
    full = T.StructType(list(schema.fields) + [T.StructField("_corrupt_record", S)])
    return df.select(*keep, F.from_json(F.col(text_col), full).alias("__d")) \
        .select(*keep, "__d.*")


def _user(user_id, user_col) -> Column:
    if user_col is not None:
        return F.col(user_col).cast("string")
    return F.lit(user_id).cast("string")


def _bad_doc(df: DataFrame, required: list[str]) -> Column:
    cond = F.lit(False)
    if "_corrupt_record" in df.columns:
        cond = cond | F.col("_corrupt_record").isNotNull()
    for r in required:
        cond = cond | F.col(r).isNull()
    return cond


def split_documents(docs: DataFrame, required: list[str]) -> tuple[DataFrame, DataFrame]:
    """(documents that have every required part, rejected documents)."""
    bad = _bad_doc(docs, required)
    return docs.filter(~bad), docs.filter(bad)


def marked_documents(docs: DataFrame, required: list[str]) -> DataFrame:
    """Every document, for the ``*_lines`` functions: ``__bad`` tells a rejected
    one, which keeps its text and file but no elements.  So one pass over parsed
    documents gives the lines, the rejects and the documents without either."""
    bad = _bad_doc(docs, required)
    file = F.col("_file") if "_file" in docs.columns else F.lit(None).cast("string")
    return docs.withColumns({"__bad": bad, "__text": F.when(bad, F.col(TEXT)), "__file": F.when(bad, file),
                             **{r: F.when(~bad, F.col(r)) for r in required}})


def parse_sessions(docs: DataFrame, user_id: str | None = None,
                   user_col: str | None = None) -> DataFrame:
    """One row per session, all session keys, plus ``user_id`` and the
    activity label."""
    s = docs.select(_user(user_id, user_col).alias("user_id"),
                    F.explode("session").alias("s"))
    return s.select("s.*", "user_id",
                    labels.activity_type_label(F.col("s.activityType"))
                    .alias("activityType_String"))


def parse_datasources(docs: DataFrame, user_id: str | None = None,
                      user_col: str | None = None) -> DataFrame:
    """S3: one row per data source, plus ``user_id``."""
    s = docs.select(_user(user_id, user_col).alias("user_id"),
                    F.explode("dataSource").alias("s"))
    return s.select("s.*", "user_id")


def _point_fields(carried: dict[str, Column], p: str = "p") -> list[Column]:
    # point keys overwrite carried ones of the same name
    own = set(POINT.fieldNames())
    return [c.alias(n) for n, c in carried.items() if n not in own] + [F.col(f"{p}.*")]


def parse_datasets(docs: DataFrame, user_id: str | None = None,
                   user_col: str | None = None) -> DataFrame:
    """One row per raw point, carrying the document's time range and
    source id."""
    s = docs.select(_user(user_id, user_col).alias("user_id"), "minStartTimeNs",
                    "maxEndTimeNs", "dataSourceId", F.explode("point").alias("p"))
    return s.select(*_point_fields({"user_id": F.col("user_id"),
                                    "minStartTimeNs": F.col("minStartTimeNs"),
                                    "maxEndTimeNs": F.col("maxEndTimeNs"),
                                    "dataSourceId": F.col("dataSourceId")}))


def parse_aggregated(docs: DataFrame, user_id: str | None = None,
                     user_col: str | None = None) -> DataFrame:
    """bucket[] → dataset[] → point[]; each point carries its bucket's
    start/end and its dataset's source id.  Empty arrays give no rows."""
    b = docs.select(_user(user_id, user_col).alias("user_id"),
                    F.explode("bucket").alias("b"))
    d = b.select("user_id", F.col("b.startTimeMillis").alias("startTimeMillis"),
                 F.col("b.endTimeMillis").alias("endTimeMillis"),
                 F.explode("b.dataset").alias("d"))
    p = d.select("user_id", "startTimeMillis", "endTimeMillis",
                 F.col("d.dataSourceId").alias("dataSourceId"),
                 F.explode("d.point").alias("p"))
    return p.select(*_point_fields({c: F.col(c) for c in
                                    ("user_id", "startTimeMillis", "endTimeMillis",
                                     "dataSourceId")}))


# ---- lake lines with every key of an element ----------------------------------

_MARKS = ("__bad", "__text", "__file")


def _marks(docs: DataFrame) -> list[str]:
    return [c for c in _MARKS if c in docs.columns]


def _texted(docs: DataFrame, schema: T.StructType) -> DataFrame:
    if TEXTS in docs.columns:
        return docs
    return docs.withColumn(TEXTS, F.lit(None).cast(_as_text(schema)))


def _each(docs: DataFrame, keep: list[Column], part: str, text: str, name: str) -> DataFrame:
    """The elements of an array as ``v``, each with its text ``t`` if there is
    one; of marked documents, one null where the array is empty, and ``__gone``
    tells so."""
    pairs = F.arrays_zip(F.col(part).alias("v"), F.coalesce(F.col(text), F.array()).alias("t"))
    # made before the array is taken apart, whose rows then do not carry it
    docs = docs.select(*keep, *_marks(docs), (F.coalesce(F.size(part), F.lit(0)) < 1).alias("__gone"), pairs.alias("__pairs"))
    each = F.explode_outer("__pairs") if _marks(docs) else F.explode("__pairs")
    return docs.select(*[c for c in docs.columns if c != "__pairs"], each.alias(name))


def _tag(name: str, value: Column) -> Column:
    """A tag as the text of a key and its value, null where it is not set."""
    text = F.when(value.rlike(r'["\\\x00-\x1f]'), F.to_json(value.cast("variant"))).otherwise(F.concat(F.lit('"'), value, F.lit('"')))
    return F.when(value.isNotNull(), F.concat(F.lit(f'"{name}":'), text)).alias(f"__tag_{name}")


def _tagged_lines(rows: DataFrame, element: str, tags: list[str], tags_win: bool) -> DataFrame:
    """Elements (VARIANT ``v``, text ``t``) → lake lines ``user_id``, ``value``,
    ``_reject_reason``.

    A line holds every key of the element and the tags that are set (columns of
    :func:`_tag`); of a name in both, the tag stays if ``tags_win``, else the
    element's own value; the user is always the tag, as landings replace lines
    by it.  An element that is no JSON object is a reject with its text as
    ``value``.

    The tags' text is put beside the element's; only an element that holds a
    key which gives way to a tag is taken apart.  Marked documents give
    ``file`` too, their reject where they are bad, and a row without value and
    reason where they hold nothing.
    """
    out = tags if tags_win else ["user_id"]                # keys that give way
    marks = _marks(rows)
    # Spark keeps a projection apart whose costly columns are used more than once
    text = F.col(f"{element}.t")
    json = F.when(text.startswith("{"), text).otherwise(F.to_json(f"{element}.v"))
    rows = rows.select(json.alias("__json"), F.col(f"{element}.v").alias("__v"), "user_id",
                       *[f"__tag_{n}" for n in tags], *marks, "__gone")

    def holds(name: str) -> Column:
        # the element's text tells most that lack the key, and faster without the quote that every key begins with
        return F.col("__json").contains(f'{name}":') & F.try_variant_get("__v", f"$.{name}", "variant").isNotNull()

    def given(name: str) -> Column:
        tag = F.col(f"__tag_{name}")
        return tag if name in out else F.when(tag.isNotNull() & ~holds(name), tag)

    own = F.when(F.greatest(*[holds(n) for n in out], F.lit(False)), F.to_json(F.map_filter(
        F.try_variant_get("__v", "$", "map<string,variant>"), lambda k, v: ~k.isin(*out)))).otherwise(F.col("__json"))
    cols = [F.col("user_id"), own.alias("__own"), F.concat_ws(",", *map(given, tags)).alias("__tags"),
            *[F.col(c) for c in (*marks, "__gone")]]
    rows = rows.select(*cols) if marks else computed(rows, cols)      # unmarked lines may be filtered
    bad = ~F.coalesce(F.col("__own").startswith("{"), F.lit(False))
    value = F.when(bad | (F.col("__tags") == ""), F.col("__own")) \
        .when(F.col("__own") == "{}", F.concat(F.lit("{"), F.col("__tags"), F.lit("}"))) \
        .otherwise(F.concat(F.lit("{"), F.col("__tags"), F.lit(","), F.substring("__own", 2, 2**31 - 1)))
    reason = F.when(bad, F.lit("element is not an object"))
    if not marks:
        return rows.select("user_id", value.alias("value"), reason.alias(REASON))
    return rows.select("user_id", F.col("__file").alias("file"),
                       F.when(F.col("__bad"), F.lit("document")).when(~F.col("__gone"), reason).alias(REASON),
                       F.when(F.col("__bad"), F.col("__text")).when(~F.col("__gone"), value).alias("value"))


def session_lines(docs: DataFrame, user_id: str | None = None,
                  user_col: str | None = None) -> DataFrame:
    """S2 to the lake: each session with all its keys, the user and the
    activity label (which replace keys of the same names)."""
    docs, user = _texted(docs, SESSIONS_RAW), _user(user_id, user_col)
    s = _each(docs, [user.alias("user_id"), _tag("user_id", user)], "session", f"{TEXTS}.session", "s")
    kind = F.try_variant_get(F.col("s.v"), "$.activityType", "bigint")
    s = s.select("*", _tag("activityType_String", labels.activity_type_label(kind)))
    return _tagged_lines(s, "s", ["user_id", "activityType_String"], True)


def datasource_lines(docs: DataFrame, user_id: str | None = None,
                     user_col: str | None = None) -> DataFrame:
    """S3 to the lake: each data source with all its keys and the user."""
    docs, user = _texted(docs, DATASOURCES_RAW), _user(user_id, user_col)
    s = _each(docs, [user.alias("user_id"), _tag("user_id", user)], "dataSource", f"{TEXTS}.dataSource", "s")
    return _tagged_lines(s, "s", ["user_id"], True)


def dataset_lines(docs: DataFrame, user_id: str | None = None,
                  user_col: str | None = None) -> DataFrame:
    """S4 to the lake: each raw point with all its keys, and of the user, time
    range and source id those that the point lacks."""
    carried = ["minStartTimeNs", "maxEndTimeNs", "dataSourceId"]
    docs, user = _texted(docs, DATASETS_RAW), _user(user_id, user_col)
    p = _each(docs, [user.alias("user_id"), _tag("user_id", user), *[_tag(c, F.col(c)) for c in carried]],
              "point", f"{TEXTS}.point", "p")
    return _tagged_lines(p, "p", ["user_id", *carried], False)


def aggregated_lines(docs: DataFrame, user_id: str | None = None,
                     user_col: str | None = None) -> DataFrame:
    """S5 to the lake: each point with all its keys, and of the user, bucket
    times and source id those that the point lacks."""
    docs, user = _texted(docs, AGGREGATED_RAW), _user(user_id, user_col)
    b = _each(docs, [user.alias("user_id"), _tag("user_id", user)], "bucket", f"{TEXTS}.bucket", "b")
    held, times = [F.col("user_id"), F.col("__tag_user_id")], ["startTimeMillis", "endTimeMillis"]
    d = _each(b, [*held, *[_tag(c, F.col(f"b.v.{c}")) for c in times]], "b.v.dataset", "b.t.dataset", "d")
    p = _each(d, [*held, *[F.col(f"__tag_{c}") for c in times], _tag("dataSourceId", F.col("d.v.dataSourceId"))],
              "d.v.point", "d.t.point", "p")
    return _tagged_lines(p, "p", ["user_id", *times, "dataSourceId"], False)


def header_name(h) -> Column:
    """Header → key: lower case, blanks → ``_``."""
    return F.replace(F.lower(h), F.lit(" "), F.lit("_"))


def parse_matrix(docs: DataFrame, *, load_tz, output_date, output_tz="UTC",
                 user_id: str | None = None, user_col: str | None = None,
                 date_key: str = "date", fixed_day: bool = True) -> DataFrame:
    """S6 + P11: ``row_headers`` zipped with each row into a string map.

    ``date`` is civil time in ``load_tz`` (a zone name or a column); a row is
    kept when its instant lies in ``[output_date 00:00 in output_tz, +24 h)``
    and then gets ``date_timestamp_millis``.  ``output_date`` may be a column
    (one output day per document).  ``fixed_day`` keeps the original fixed
    24 h window; ``False`` ends the window at the next local midnight of
    ``output_tz`` instead (23 or 25 h on DST change days).  Rows whose date does not parse, documents
    without a date header or with a null header, and rows longer than the header
    come back with ``_reject_reason``.  Where headers collide after normalising,
    the last cell of the row wins.
    The user and ``date_timestamp_millis`` replace headers of those names.
    """
    names = F.transform(F.col("row_headers"), header_name)
    out_date = output_date if isinstance(output_date, Column) \
        else F.lit(timez.to_date_value(output_date))
    tz_out = output_tz if isinstance(output_tz, Column) else F.lit(output_tz)
    day_start = F.unix_millis(F.to_utc_timestamp(out_date.cast("timestamp"), tz_out))
    day_end = day_start + F.lit(timez.MILLIS_PER_DAY) if fixed_day else F.unix_millis(
        F.to_utc_timestamp(F.date_add(out_date, 1).cast("timestamp"), tz_out))
    zone = load_tz if isinstance(load_tz, Column) else F.lit(load_tz)
    rows = docs.select(_user(user_id, user_col).alias("user_id"), names.alias("names"),
                       day_start.alias("lo"), day_end.alias("hi"), zone.alias("__zone"),
                       F.explode("rows").alias("r"))
    # of equal headers the last cell counts, in the place of the first; a header
    # named like a tag gives way to the tag
    used = F.slice(F.col("names"), 1, F.size("r"))
    last = F.transform(F.array_distinct(used), lambda n: F.struct(n.alias("k"), F.get(
        F.col("r"), F.size(used) - F.array_position(F.reverse(used), n).cast("int")).alias("v")))
    cells = F.when(F.size(F.array_distinct(used)) == F.size(used), F.arrays_zip(used.alias("k"), F.col("r").alias("v"))) \
        .otherwise(last)
    fields = F.map_filter(F.map_from_entries(cells),
                          lambda k, v: ~k.isin("user_id", "date_timestamp_millis"))
    doc_bad = F.when(F.exists("names", lambda n: n.isNull()), F.lit("header without a name")) \
        .when(~F.array_contains("names", F.lit(date_key)), F.lit("no date header")) \
        .when(F.size("r") > F.size("names"), F.lit("row longer than header"))
    rows = rows.select("user_id", "lo", "hi", "r", "__zone",
                       F.when(doc_bad.isNull(), fields).alias("fields"),
                       doc_bad.alias("doc_bad"))
    ms = timez.parse_local_millis(F.col("fields")[date_key], F.col("__zone"))
    rows = rows.withColumn("ms", ms)
    reason = F.coalesce(F.col("doc_bad"),
                        F.when(F.col("ms").isNull(), F.lit("unparsable date")))
    keep = reason.isNotNull() | ((F.col("ms") >= F.col("lo")) & (F.col("ms") < F.col("hi")))
    # the row's text is kept for rejects only
    rows = computed(rows, [F.col(c) for c in rows.columns if c != "r"]
                    + [reason.alias(REASON), keep.alias("__keep"),
                       F.when(reason.isNotNull(), F.to_json("r")).alias("_line")])
    rows = rows.filter(F.col("__keep"))
    return rows.select(
        "user_id",
        F.when(F.col(REASON).isNull(), F.map_concat(
            F.col("fields"),
            F.create_map(F.lit("date_timestamp_millis"), F.col("ms").cast("string"))))
        .alias("fields"),
        REASON, "_line")


def matrix_json(rows: DataFrame) -> Column:
    """Lake line text of parsed matrix rows: ``{"user_id": …, <fields>}``."""
    return F.to_json(F.map_concat(F.create_map(F.lit("user_id"), F.col("user_id")), F.col("fields")))


def matrix_row_json(rows: DataFrame) -> DataFrame:
    return rows.select(matrix_json(rows).alias("value"))
