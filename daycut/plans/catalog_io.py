"""Registered landing, flatten, interval and load queries, with oracles.

The inputs are API answers and lake lines that Spark derives from the whole
``events`` table (``landed``); the oracles compute the expected warehouse rows
directly from ``events``.  Load queries write into a fresh folder below the
session's ``spark.checkpoint.dir`` and return the table read back.
"""

from __future__ import annotations

import datetime as _dt
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daycut.functions import timez
from daycut.operators import daily, flatten, intervals
from daycut.plans import jobs, landed, standins
from daycut.session import apply_conf, scratch_path
from daycut.sinks import lake, warehouse
from daycut.sources import landing, schema

# ---- fixed parameters -------------------------------------------------------------
# a load window narrower than the data: sessions outside it become negative rows
NARROW_LO_MS, NARROW_HI_MS = 1_704_844_800_000, 1_705_708_800_000   # 2024-01-10, -20
# ------------------------------------------------------------------------------------

SESSION_COLS = [f.name for f in schema.SESSIONS.fields]
POINT_COLS = [f.name for f in schema.AGGREGATED_DATASETS.fields]
TRACKING_COLS = [f.name for f in schema.TIME_TRACKING.fields]


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    apply_conf(spark)
    return standins.read_events(spark, sf_dir, spread_rows=True)


def _with(target: T.StructType, *extra: tuple[str, str]) -> T.StructType:
    return T.StructType(list(target.fields) + list(schema.struct_from_fields(extra).fields))


def _json_lines(df: DataFrame, keep=()) -> DataFrame:
    cols = [c for c in df.columns if c not in keep]
    return df.select(*keep, lake.json_line(cols).alias("value"))


def _good(rows: DataFrame) -> DataFrame:
    return flatten.split_rejects(rows)[0]


# ---- landing parsers -----------------------------------------------------------------

def parsed_sessions(spark, sf_dir) -> DataFrame:
    docs = landing.envelopes_from_text(landed.session_documents(_events(spark, sf_dir)),
                                       landing.SESSIONS_ENVELOPE, keep=["user_id"])
    return landing.parse_sessions(docs, user_col="user_id")


def q_parse_sessions(spark, sf_dir):
    """S2 + P1/P3/P4: session answers → session rows of the warehouse schema."""
    lines = _json_lines(parsed_sessions(spark, sf_dir))
    return _good(flatten.flatten_project(lines, schema.SESSIONS,
                                         input_schema=jobs.SESSION_LINE))


def q_parse_datasources(spark, sf_dir):
    """S3: data-source answers → one row per (user, source)."""
    docs = landing.envelopes_from_text(landed.datasource_documents(_events(spark, sf_dir)),
                                       landing.DATASOURCES_ENVELOPE, keep=["user_id"])
    return landing.parse_datasources(docs, user_col="user_id") \
        .select("user_id", "dataStreamId", "dataStreamName", "type")


def q_parse_datasets(spark, sf_dir):
    """Raw-point answers → points carrying the answer's time range."""
    docs = landing.envelopes_from_text(landed.dataset_documents(_events(spark, sf_dir)),
                                       landing.DATASETS_ENVELOPE, keep=["user_id"])
    rows = landing.parse_datasets(docs, user_col="user_id")
    target = _with(schema.AGGREGATED_DATASETS, ("minStartTimeNs", "INT64"),
                   ("maxEndTimeNs", "INT64"))
    return _good(flatten.flatten_project(_json_lines(rows), target,
                                         input_schema=jobs.POINT_LINE))


def parsed_aggregated(spark, sf_dir) -> DataFrame:
    docs = landing.envelopes_from_text(landed.aggregated_documents(_events(spark, sf_dir)),
                                       landing.AGGREGATED_ENVELOPE, keep=["user_id"])
    return landing.parse_aggregated(docs, user_col="user_id")


def q_parse_aggregated(spark, sf_dir):
    """Bucket → dataset → point answers → points with their bucket."""
    target = _with(schema.AGGREGATED_DATASETS, ("startTimeMillis", "INT64"),
                   ("endTimeMillis", "INT64"))
    return _good(flatten.flatten_project(_json_lines(parsed_aggregated(spark, sf_dir)),
                                         target, input_schema=jobs.POINT_LINE))


def q_parse_matrix(spark, sf_dir):
    """S6 + P8 + P11 + B2 rows: header/rows answers in the user's zone, each
    landed for the two UTC days its local day touches; every row is kept on
    exactly one of them."""
    docs = landing.envelopes_from_text(landed.matrix_documents(_events(spark, sf_dir)),
                                       landing.MATRIX_ENVELOPE, keep=["user_id", "local_day"])
    # each parsed answer is landed for both UTC days its local day touches
    docs = docs.select("*", F.explode(F.array(F.date_sub("local_day", 1), F.col("local_day")))
                       .alias("out_day"))
    parsed = landing.parse_matrix(docs, load_tz=landed.LOAD_TZ, output_date=F.col("out_day"),
                                  output_tz="UTC", user_col="user_id")
    good = parsed.filter(F.col(landing.REASON).isNull())
    rows, _ = jobs.time_tracking_rows(landing.matrix_row_json(good))
    return rows.select(*TRACKING_COLS)


# ---- flatten, productivity, rejects ----------------------------------------------------

def q_flatten_time_tracking(spark, sf_dir):
    """Flat lake lines → time-tracking rows (bad codes rejected)."""
    good, _ = jobs.time_tracking_rows(landed.time_tracking_lines(_events(spark, sf_dir)))
    return good.select(*TRACKING_COLS)


def q_split_rejects(spark, sf_dir):
    """K5: the rejected lines, counted per reason."""
    _, rejects = jobs.time_tracking_rows(landed.time_tracking_lines(_events(spark, sf_dir)))
    return rejects.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


# ---- intervals and dedup -----------------------------------------------------------------

def q_split_intervals(spark, sf_dir):
    """Clip to a 10-day window, split in 30-minute pieces (sessions
    outside the window stay as one negative-length row)."""
    s = standins.sessions_from_events(_events(spark, sf_dir))
    s = intervals.clip_intervals(s, "startTimeMillis", "endTimeMillis",
                                 NARROW_LO_MS, NARROW_HI_MS)
    return intervals.split_intervals(s, "startTimeMillis", "endTimeMillis")


def delivered_sessions(events: DataFrame) -> DataFrame:
    """Each session once per UTC day it touches (as the API reports it)."""
    s = standins.sessions_from_events(events)
    d0 = F.to_date(timez.millis_to_instant("startTimeMillis"))
    d1 = F.to_date(timez.millis_to_instant("endTimeMillis"))
    return s.select("*", F.explode(F.when(d0 <= d1, F.sequence(d0, d1)).otherwise(F.array(d0)))
                    .alias("day"))


def q_dedup_sessions(spark, sf_dir):
    """Deliveries on both touched days, clipped to the window that all of
    them span and split, collapse to distinct (user, start, end, app) pieces."""
    s = delivered_sessions(_events(spark, sf_dir)).drop("day")
    lo, hi = s.agg(F.min("startTimeMillis"), F.max("endTimeMillis")).head()
    s = intervals.clip_intervals(s, "startTimeMillis", "endTimeMillis", lo or 0, hi or 0)
    s = intervals.split_intervals(s, "startTimeMillis", "endTimeMillis")
    return daily.dedup(s, ["user_id", "startTimeMillis", "endTimeMillis",
                           "application_packageName"])


# ---- lake and warehouse round trips ---------------------------------------------------------

def q_lake_roundtrip(spark, sf_dir):
    """Session rows → sharded JSONL per (day, dataset) prefix → scan of
    the whole lake → rows again."""
    rows = parsed_sessions(spark, sf_dir)
    rows = rows.withColumn("day", F.to_date(timez.millis_to_instant(
        F.col("startTimeMillis").cast("long"))))
    root = scratch_path(spark, "lake")
    jobs.land_documents(rows, root, jobs.DATASETS["sessions"])
    lines = lake.scan_jsonl(spark, root, dataset=jobs.DATASETS["sessions"])
    good = _good(flatten.flatten_project(lines, schema.SESSIONS, input_schema=jobs.SESSION_LINE))
    return good.select(*SESSION_COLS)


def q_load_time_tracking(spark, sf_dir):
    """B2/K3/K4: lake lines → rows → day partitions clustered by user → read."""
    root = scratch_path(spark, "lake")
    lines = landed.time_tracking_lines(_events(spark, sf_dir)) \
        .withColumn("dataset", F.lit(jobs.DATASETS["time_tracking"]))
    lake.write_sharded_jsonl(lines, root)
    good, _ = jobs.time_tracking_rows(
        lake.scan_jsonl(spark, root, dataset=jobs.DATASETS["time_tracking"]))
    table = scratch_path(spark, "time_tracking")
    jobs.load_all_days(good.select(*TRACKING_COLS, "day"), table, jobs.TRACKING_CLUSTER)
    return warehouse.read_table(spark, table).select(*TRACKING_COLS, "day")


def q_load_fitness_sessions(spark, sf_dir):
    """B1 sessions branch for every day: deliveries landed per UTC day, each
    clipped to its own day window and split, loaded into day partitions."""
    ev = _events(spark, sf_dir)
    s = delivered_sessions(ev)
    item = F.struct(F.col("id"), F.col("name"),
                    *[F.col(c).cast("string").alias(c) for c in
                      ("startTimeMillis", "endTimeMillis", "modifiedTimeMillis")],
                    F.struct(F.col("application_packageName").alias("packageName"))
                    .alias("application"),
                    F.col("activityType"), F.col("user_id"), F.col("activityType_String"))
    rows = s.select("day", "user_id", item.alias("r")).select("day", "r.*")
    root = scratch_path(spark, "lake")
    jobs.land_documents(rows, root, jobs.DATASETS["sessions"])
    lines = lake.scan_jsonl(spark, root, dataset=jobs.DATASETS["sessions"])
    lo = F.unix_millis(F.col("day").cast("timestamp"))
    good, _ = jobs.session_rows(lines, lo=lo, hi=lo + F.lit(timez.MILLIS_PER_DAY))
    table = scratch_path(spark, "sessions")
    jobs.load_all_days(good.select(*SESSION_COLS, "day"), table, jobs.SESSION_CLUSTER)
    return warehouse.read_table(spark, table).select(*SESSION_COLS, "day")


def q_load_fitness_points(spark, sf_dir):
    """B1 points branch for every day: aggregated answers → lake → day
    partitions clustered by (user, time) → read."""
    rows = parsed_aggregated(spark, sf_dir)
    ms = timez.nanos_to_millis(F.col("startTimeNanos").cast("long"))
    rows = rows.withColumn("day", F.to_date(timez.millis_to_instant(ms)))
    root = scratch_path(spark, "lake")
    jobs.land_documents(rows, root, jobs.DATASETS["points"])
    pts, _ = jobs.point_rows(lake.scan_jsonl(spark, root, dataset=jobs.DATASETS["points"]))
    table = scratch_path(spark, "points")
    jobs.load_all_days(pts.select(*POINT_COLS, "day"), table, jobs.POINT_CLUSTER)
    return warehouse.read_table(spark, table).select(*POINT_COLS, "day")


LAND_DAY = "2024-01-31"
#: Of each landed dataset: its key column and a key that no schema here names.
LANDED_KEYS = {"sessions": ("id", "activeTimeMillis"), "points": ("startTimeNanos", "computationTimeMillis"),
               "datasources": ("dataStreamId", "vendor"), "raw_points": ("startTimeNanos", "computationTimeMillis")}


def _land_all(spark, sf_dir) -> tuple[str, DataFrame]:
    """Saved answers of the four fitness datasets, each with a broken document
    per user, landed for one day: lake root and rejects."""
    ev = _events(spark, sf_dir)
    broken = ev.select(F.col("user_id").cast("string").alias("user_id")).distinct() \
        .withColumn("value", F.concat(F.lit("{broken "), F.col("user_id")))
    answers = {"sessions": landed.session_documents, "points": landed.aggregated_documents,
               "datasources": landed.datasource_documents, "raw_points": landed.dataset_documents}
    root = scratch_path(spark, "lake")

    def one(kind: str) -> DataFrame:
        saved = scratch_path(spark, f"answers-{kind}")
        answers[kind](ev).select("user_id", "value").unionByName(broken).write.parquet(saved)
        docs = spark.read.parquet(saved).withColumnsRenamed({"user_id": "__user", "value": landing.TEXT})
        return jobs.land_answers(landing.parsed_once(docs, jobs.FITNESS[kind][0]), kind, root, LAND_DAY, user_col="__user")

    # independent prefixes of the lake, landed at the same time
    with ThreadPoolExecutor(len(answers)) as pool:
        rejects = list(pool.map(inheritable_thread_target(spark)(one), answers))
    return root, reduce(DataFrame.unionByName, rejects)


def q_land_fitness(spark, sf_dir):
    """Saved answers of four datasets → lake lines, unknown keys kept."""
    root, _ = _land_all(spark, sf_dir)
    out = None
    for kind, (key, other) in LANDED_KEYS.items():
        lines = lake.scan_jsonl(spark, root, day=LAND_DAY, dataset=jobs.DATASETS[kind])
        part = lines.select("dataset", F.json_tuple("value", "user_id", key, other).alias("user_id", "key", "unknown"))
        out = part if out is None else out.unionByName(part)
    return out


def q_landing_rejects(spark, sf_dir):
    """The rejected documents of the same landing, counted per dataset."""
    _, rejects = _land_all(spark, sf_dir)
    return rejects.groupBy("dataset", F.col(landing.REASON).alias("reason")) \
        .agg(F.count(F.lit(1)).alias("n"), F.countDistinct("text").alias("texts"))


#: A table schema with columns of nested keys that no line schema declares.
DYNAMIC_SCHEMA = schema.schema_json("devices", [
    ("user_id", "STRING"), ("device_uid", "STRING"), ("device_firmware_build", "INT64"),
    ("value0_fpVal", "FLOAT64"), ("parts1_spec_load", "INT64"), ("no_such_key", "STRING"),
    ("a_b_c_d_e_f_g_h_i_j", "INT64"), ("dotted_key_in_it", "STRING")])


def q_flatten_dynamic(spark, sf_dir):
    """A schema file decides which nested keys become columns."""
    path = scratch_path(spark, "schema")
    spark.createDataFrame([(DYNAMIC_SCHEMA,)], "value string").coalesce(1).write.text(path)
    num = F.col("event_id")
    parts = F.array(*[F.struct(F.struct(load.alias("load")).alias("spec")) for load in (num, num * 2)])
    deep = num * 3
    for key in "jihgfedcb":
        deep = F.struct(deep.alias(key))
    dotted = F.struct(F.col("event_type").alias("key.in_[it]"))
    lines = _events(spark, sf_dir).select(F.to_json(F.struct(
        F.col("user_id").cast("string").alias("user_id"),
        F.struct(F.concat(F.lit("d"), num).alias("uid"),
                 F.struct((num + 1).alias("build")).alias("firmware")).alias("device"),
        parts.alias("parts"), F.array(F.struct(F.col("value").alias("fpVal"))).alias("value"),
        deep.alias("a"), dotted.alias("dotted"))).alias("value"))
    return jobs.point_rows(lines, path)[0]


def land_users_of(ev: DataFrame, users: Column, bump: Column, tasks: int | None = None) -> DataFrame:
    """Saved sessions answers of the users that ``users`` tells."""
    docs = landed.session_documents(ev.where(users).withColumn("event_id", F.col("event_id") + bump), tasks)
    return docs.select(F.col("user_id").alias("__user"), F.col("value").alias(landing.TEXT))


def q_land_users(spark, sf_dir):
    """Every user's answers landed for one day in two runs of different
    users into one lake root; then one half of the users once more, with other
    sessions.  Each run replaces its own users' lines and keeps the others'."""
    apply_conf(spark)
    ev, root = standins.read_events(spark, sf_dir), scratch_path(spark, "lake")
    even, tasks = F.col("user_id") % 2 == 0, landed.document_tasks(ev)
    for users, bump in ((even, 0), (~even, 0), (even, 1_000_000_000)):
        docs = land_users_of(ev, users, F.lit(bump), tasks)
        jobs.land_answers(landing.parsed_once(docs, jobs.FITNESS["sessions"][0]), "sessions", root, LAND_DAY,
                          user_col="__user")
    lines = lake.scan_jsonl(spark, root, day=LAND_DAY, dataset=jobs.DATASETS["sessions"])
    return lines.select(F.json_tuple("value", "user_id", "id").alias("user_id", "id"))


def q_load_partition(spark, sf_dir):
    """K3: every time-tracking day of the lake loaded; then the last day landed
    anew with the lines of the first and loaded once more.  The days between
    stay as they were."""
    ev, root = _events(spark, sf_dir), scratch_path(spark, "lake")
    kind = jobs.DATASETS["time_tracking"]
    lines = landed.time_tracking_lines(ev).withColumn("dataset", F.lit(kind))
    lake.write_sharded_jsonl(lines, root)
    span = lake.scan_jsonl(spark, root).agg(F.min("day").alias("lo"), F.max("day").alias("hi")).head()
    windows = [jobs.day_window(span.lo + _dt.timedelta(days=i)) for i in range((span.hi - span.lo).days + 1)]
    table = scratch_path(spark, "time_tracking")
    jobs.load_windows(spark, root, {"time_tracking": table}, windows)
    lake.write_prefix(lake.scan_jsonl(spark, root, day=span.lo, dataset=kind), root, {"day": span.hi, "dataset": kind})
    jobs.job_load_time_tracking(spark, root, table, jobs.day_window(span.hi))
    return warehouse.read_table(spark, table).select(*TRACKING_COLS, "day")


def q_land_time_tracking(spark, sf_dir):
    """Matrix answers of every user landed for the second day of the data,
    each read in the zone that a table gives its user; a user without a zone
    is rejected.  The day's rows, and per user the kept rejects."""
    ev = _events(spark, sf_dir)
    day = ev.select(F.to_date(F.min("ts"))).head()[0] + _dt.timedelta(days=1)
    zones = ev.select(F.col("user_id").cast("string").alias("user_id"), F.element_at(F.array(
        F.lit("Asia/Seoul"), F.lit("America/New_York"), F.lit(None).cast("string")), (F.col("user_id") % 3 + 1).cast("int"))
        .alias("__tz")).distinct()
    docs = landed.matrix_documents(ev).select("user_id", F.col("value").alias(landing.TEXT)).join(zones, "user_id", "left")
    root, kept = scratch_path(spark, "lake"), scratch_path(spark, "landing-rejects")
    jobs.land_matrices(landing.parsed_once(docs, landing.MATRIX_ENVELOPE), root, day, load_tz=F.col("__tz"),
                       user_col="user_id", rejects_table=kept)
    good, _ = jobs.time_tracking_rows(lake.scan_jsonl(spark, root, day=day, dataset=jobs.DATASETS["time_tracking"]))
    bad = lake.scan_jsonl(spark, kept, day=day).select(F.get_json_object("value", "$.user_id").alias("user_id"),
                                                       F.get_json_object("value", "$.reason").alias("activity"))
    return good.select("user_id", "date_timestamp_millis", "time_spent_seconds", "activity", "category").unionByName(
        bad, allowMissingColumns=True)


def q_reload_days(spark, sf_dir):
    """Every day of the lake loaded into the three tables in one pass;
    then the last time-tracking day is landed anew without lines, and the
    two-day reload of that day run.  Rows and sums per table and day, rejects
    included."""
    ev = _events(spark, sf_dir)
    root = scratch_path(spark, "lake")
    lake.write_sharded_jsonl(landed.time_tracking_lines(ev).withColumn(
        "dataset", F.lit(jobs.DATASETS["time_tracking"])), root, user_col="user")
    sessions = delivered_sessions(ev).withColumn("application", F.struct(
        F.col("application_packageName").alias("packageName"))).drop("application_packageName")
    jobs.land_documents(sessions, root, jobs.DATASETS["sessions"])
    points = parsed_aggregated(spark, sf_dir)
    ms = timez.nanos_to_millis(F.col("startTimeNanos").cast("long"))
    jobs.land_documents(points.withColumn("day", F.to_date(timez.millis_to_instant(ms))), root,
                        jobs.DATASETS["points"])
    tables = {kind: scratch_path(spark, kind) for kind in ("points", "sessions", "time_tracking")}
    rejects = scratch_path(spark, "rejects")
    held = lake.days_held(spark, root)
    tracked = lake.days_held(spark, root, jobs.DATASETS["time_tracking"])[-1]
    windows = [jobs.day_window(held[0] + _dt.timedelta(days=i)) for i in range((held[-1] - held[0]).days + 1)]
    jobs.load_windows(spark, root, tables, windows, rejects)
    lake.write_prefix(spark.createDataFrame([], "value string"), root,
                      {"day": tracked, "dataset": jobs.DATASETS["time_tracking"]})
    jobs.run_reload(spark, tracked, root, tables, rejects)
    sums = {"points": F.col("endTimeNanos") - F.col("startTimeNanos"),
            "sessions": F.col("endTimeMillis") - F.col("startTimeMillis"),
            "time_tracking": F.col("date_timestamp_millis") + F.col("time_spent_seconds")}
    parts = [warehouse.read_table(spark, tables[k]).select(F.lit(k).alias("tbl"), "day", v.alias("x"))
             for k, v in sums.items()]
    bad = warehouse.read_table(spark, f"{rejects}/dataset={jobs.DATASETS['time_tracking']}")
    parts.append(bad.select(F.lit("rejects").alias("tbl"), "day", F.lit(0).cast("long").alias("x")))
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return rows.groupBy("tbl", "day").agg(F.count(F.lit(1)).alias("n"), F.sum("x").alias("total"))


QUERIES = {
    "parse_sessions": q_parse_sessions,
    "parse_datasources": q_parse_datasources,
    "parse_datasets": q_parse_datasets,
    "parse_aggregated": q_parse_aggregated,
    "parse_matrix": q_parse_matrix,
    "flatten_time_tracking": q_flatten_time_tracking,
    "split_rejects": q_split_rejects,
    "split_intervals": q_split_intervals,
    "dedup_sessions": q_dedup_sessions,
    "lake_roundtrip": q_lake_roundtrip,
    "load_time_tracking": q_load_time_tracking,
    "load_fitness_sessions": q_load_fitness_sessions,
    "load_fitness_points": q_load_fitness_points,
    "land_fitness": q_land_fitness,
    "landing_rejects": q_landing_rejects,
    "flatten_dynamic": q_flatten_dynamic,
    "land_users": q_land_users,
    "load_partition": q_load_partition,
    "land_time_tracking": q_land_time_tracking,
    "reload_days": q_reload_days,
}


# ---- oracle SQL ----------------------------------------------------------------------------

def _cols(names):
    return ", ".join(names)


def split_sql(src: str, lo: str, hi: str, name: str = "pieces") -> str:
    """CTEs clipping ``src`` to [lo, hi] and splitting it into 30-minute pieces."""
    return f"""clipped AS (
  SELECT * REPLACE (greatest(startTimeMillis, {lo}) AS startTimeMillis,
                    least(endTimeMillis, {hi}) AS endTimeMillis)
  FROM {src}),
{name} AS (
  SELECT * EXCLUDE (p, endTimeMillis) REPLACE (p AS startTimeMillis),
         least(p + 1800000, endTimeMillis) AS endTimeMillis
  FROM (SELECT *, unnest(generate_series(startTimeMillis, endTimeMillis, 1800000)) AS p
        FROM clipped WHERE endTimeMillis - startTimeMillis > 1800000)
  UNION ALL BY NAME
  SELECT * FROM clipped WHERE NOT (endTimeMillis - startTimeMillis > 1800000))"""


DELIVERED_SQL = f"""s AS ({standins.ORACLE_SESSIONS}),
delivered AS (
  SELECT *, CAST(unnest(generate_series(CAST(epoch_ms(startTimeMillis) AS DATE),
                                        CAST(epoch_ms(endTimeMillis) AS DATE),
                                        INTERVAL 1 DAY)) AS DATE) AS day
  FROM s)"""

TRACKING_SQL = """
  SELECT CAST(user_id AS VARCHAR) AS user_id,
         {ms} AS date_timestamp_millis,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS time_spent_seconds,
         'a' || json_extract_string(props, '$.k') AS activity,
         event_type AS category,
         CASE {code} WHEN -2 THEN 'very distracting' WHEN -1 THEN 'distracting'
              WHEN 0 THEN 'neutral' WHEN 1 THEN 'productive'
              WHEN 2 THEN 'very productive' END AS productivity_string,
         CAST({code} AS BIGINT) AS productivity{extra}
  FROM events"""

DAY_START_MS = "(epoch_us(CAST(day AS TIMESTAMP)) // 1000)"
BUCKET_START = "CAST(floor(round(startTimeNanos / 1000000) / 1800000) AS BIGINT) * 1800000"

ORACLE = {
    "parse_sessions": f"SELECT {_cols(SESSION_COLS)} FROM ({standins.ORACLE_SESSIONS})",
    "parse_datasources": """SELECT DISTINCT CAST(user_id AS VARCHAR) AS user_id,
       'derived:' || event_type AS dataStreamId, event_type AS dataStreamName,
       'derived' AS type
FROM events""",
    "parse_datasets": f"""SELECT {_cols(POINT_COLS)},
       min(startTimeNanos) OVER w AS minStartTimeNs,
       max(endTimeNanos) OVER w AS maxEndTimeNs
FROM ({standins.ORACLE_POINTS})
WINDOW w AS (PARTITION BY user_id, dataSourceId, page)""",
    "parse_aggregated": f"""SELECT {_cols(POINT_COLS)},
       {BUCKET_START} AS startTimeMillis,
       {BUCKET_START} + 1800000 AS endTimeMillis
FROM ({standins.ORACLE_POINTS})""",
    "parse_matrix": TRACKING_SQL.format(ms="(epoch_us(ts) // 1000000) * 1000",
                                        code="(event_id % 5 - 2)", extra=""),
    "flatten_time_tracking": TRACKING_SQL.format(ms="epoch_us(ts) // 1000",
                                                 code="(event_id % 7 - 3)", extra="")
    + " WHERE event_id % 7 - 3 BETWEEN -2 AND 2",
    "split_rejects": """SELECT 'bad productivity code' AS reason, COUNT(*) AS n
FROM events WHERE event_id % 7 IN (0, 6) GROUP BY 1 HAVING COUNT(*) > 0""",
    "split_intervals": f"""WITH s AS ({standins.ORACLE_SESSIONS}),
{split_sql("s", str(NARROW_LO_MS), str(NARROW_HI_MS))}
SELECT {_cols(SESSION_COLS)} FROM pieces""",
    "dedup_sessions": f"""WITH {DELIVERED_SQL},
{split_sql("delivered", "(SELECT min(startTimeMillis) FROM delivered)", "(SELECT max(endTimeMillis) FROM delivered)")}
SELECT DISTINCT user_id, startTimeMillis, endTimeMillis, application_packageName
FROM pieces""",
    "lake_roundtrip": f"SELECT {_cols(SESSION_COLS)} FROM ({standins.ORACLE_SESSIONS})",
    "load_time_tracking": TRACKING_SQL.format(
        ms="epoch_us(ts) // 1000", code="(event_id % 7 - 3)",
        extra=",\n         CAST(ts AS DATE) AS day")
    + " WHERE event_id % 7 - 3 BETWEEN -2 AND 2",
    "load_fitness_sessions": f"""WITH {DELIVERED_SQL},
{split_sql("delivered", DAY_START_MS, DAY_START_MS + " + 86400000")}
SELECT {_cols(SESSION_COLS)}, day FROM pieces""",
    "load_fitness_points": f"""SELECT {_cols(POINT_COLS)},
       CAST(epoch_ms(CAST(round(startTimeNanos / 1000000) AS BIGINT)) AS DATE) AS day
FROM ({standins.ORACLE_POINTS})""",
    "land_fitness": f"""WITH p AS ({standins.ORACLE_POINTS})
SELECT 'sessions' AS dataset, user_id, id AS "key",
       CAST(endTimeMillis - startTimeMillis AS VARCHAR) AS unknown
FROM ({standins.ORACLE_SESSIONS})
UNION ALL
SELECT d.dataset, user_id, CAST(startTimeNanos AS VARCHAR),
       CAST(CAST(round(startTimeNanos / 1000000) AS BIGINT) AS VARCHAR)
FROM p, (VALUES ('aggregated-datasets'), ('datasets')) d(dataset)
UNION ALL
SELECT DISTINCT 'datasources', user_id, dataSourceId, 'v-' || substr(dataSourceId, 9) FROM p""",
    "landing_rejects": """SELECT dataset, 'document' AS reason, count(DISTINCT user_id) AS n,
       count(DISTINCT user_id) AS texts
FROM events, (VALUES ('sessions'), ('aggregated-datasets'), ('datasets'), ('datasources')) d(dataset)
GROUP BY dataset""",
    "land_users": """SELECT CAST(user_id AS VARCHAR) AS user_id,
       CAST(event_id + CASE WHEN user_id % 2 = 0 THEN 1000000000 ELSE 0 END AS VARCHAR) AS id
FROM events""",
    "load_partition": "WITH d AS (SELECT min(CAST(ts AS DATE)) AS lo, max(CAST(ts AS DATE)) AS hi FROM events), t AS ("
    + TRACKING_SQL.format(ms="epoch_us(ts) // 1000", code="(event_id % 7 - 3)", extra=",\n         CAST(ts AS DATE) AS day")
    + """ WHERE event_id % 7 - 3 BETWEEN -2 AND 2)
SELECT t.* FROM t, d WHERE day < hi UNION ALL SELECT t.* REPLACE (hi AS day) FROM t, d WHERE day = lo""",
    "land_time_tracking": """WITH d AS (SELECT min(CAST(ts AS DATE)) + 1 AS day FROM events),
t AS (SELECT user_id, event_type, json_extract_string(props, '$.k') AS k, date_trunc('second', ts) AS utc,
             (date_trunc('second', ts) + INTERVAL 9 HOUR) AT TIME ZONE 'America/New_York' AS ny FROM events),
m AS (SELECT *, CASE user_id % 3 WHEN 0 THEN epoch_us(utc) // 1000 ELSE epoch_us(ny) // 1000 END AS ms FROM t)
SELECT CAST(user_id AS VARCHAR) AS user_id, ms AS date_timestamp_millis, CAST(k AS BIGINT) AS time_spent_seconds,
       'a' || k AS activity, event_type AS category
FROM m, d WHERE user_id % 3 < 2 AND CAST(epoch_ms(ms) AS DATE) = day
UNION ALL
SELECT CAST(user_id AS VARCHAR), NULL, NULL, 'unparsable date', NULL FROM m WHERE user_id % 3 = 2""",
    "flatten_dynamic": """SELECT CAST(user_id AS VARCHAR) AS user_id, 'd' || event_id AS device_uid,
       CAST(event_id + 1 AS BIGINT) AS device_firmware_build, CAST("value" AS DOUBLE) AS value0_fpVal,
       CAST(event_id * 2 AS BIGINT) AS parts1_spec_load, CAST(NULL AS VARCHAR) AS no_such_key,
       CAST(event_id * 3 AS BIGINT) AS a_b_c_d_e_f_g_h_i_j, event_type AS dotted_key_in_it
FROM events""",
    "reload_days": f"""WITH {DELIVERED_SQL},
{split_sql("delivered", DAY_START_MS, DAY_START_MS + " + 86400000")},
tracked AS (
  SELECT CAST(ts AS DATE) AS day, event_id % 7 - 3 AS code,
         epoch_us(ts) // 1000 + CAST(json_extract_string(props, '$.k') AS BIGINT) AS x
  FROM events WHERE CAST(ts AS DATE) < (SELECT CAST(max(ts) AS DATE) FROM events)),
loaded AS (
  SELECT 'sessions' AS tbl, day, endTimeMillis - startTimeMillis AS x FROM pieces
  UNION ALL
  SELECT 'points', CAST(epoch_ms(CAST(round(startTimeNanos / 1000000) AS BIGINT)) AS DATE),
         endTimeNanos - startTimeNanos
  FROM ({standins.ORACLE_POINTS})
  UNION ALL
  SELECT CASE WHEN code BETWEEN -2 AND 2 THEN 'time_tracking' ELSE 'rejects' END, day,
         CASE WHEN code BETWEEN -2 AND 2 THEN x ELSE 0 END
  FROM tracked)
SELECT tbl, day, count(*) AS n, CAST(sum(x) AS BIGINT) AS total FROM loaded GROUP BY ALL""",
}
