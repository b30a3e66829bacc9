"""Load jobs: lake JSONL → warehouse day partitions (B1, B2, B4), and the
landing job: saved API answers → lake JSONL (B3).

Transforms are separated from I/O: ``*_rows`` functions take a DataFrame of
lines and return (good rows, rejects), so they can be composed, tested and
explained without writing anything.  All of them are narrow (no shuffle); the
only shuffle of a load is the clustering before the write.
"""

from __future__ import annotations

import datetime as _dt
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daycut.functions import timez
from daycut.operators import flatten, intervals
from daycut.session import scratch_path
from daycut.sinks import lake, published, users, warehouse
from daycut.sources import landing, schema

S = T.StringType()

# Declared shape of the lake lines (what the landing writes).
POINT_LINE = T.StructType(
    [T.StructField("user_id", S), T.StructField("startTimeMillis", S),
     T.StructField("endTimeMillis", S), T.StructField("dataSourceId", S),
     T.StructField("minStartTimeNs", S), T.StructField("maxEndTimeNs", S)]
    + list(landing.POINT.fields))
SESSION_LINE = T.StructType(
    list(landing.SESSIONS_ENVELOPE["session"].dataType.elementType.fields)
    + [T.StructField("user_id", S), T.StructField("activityType_String", S)])

# Keys of a time-tracking lake line: user, the parsed time, and the export's
# headers after lower-casing and blanks → "_" (both spellings of the seconds
# column normalise to time_spent_seconds; the later one wins).
TIME_TRACKING_LINE = T.StructType([T.StructField(n, S) for n in (
    "user_id", "date", "date_timestamp_millis", "time_spent_(seconds)",
    "time_spent_seconds", "number_of_people", "activity", "category",
    "productivity_string", "productivity")])

DATASETS = {"points": "aggregated-datasets", "sessions": "sessions",
            "time_tracking": "time-tracking", "datasources": "datasources",
            "raw_points": "datasets"}

SESSION_CLUSTER = ["user_id", "startTimeMillis"]
POINT_CLUSTER = ["user_id", "startTimeNanos"]
TRACKING_CLUSTER = ["user_id", "date_timestamp_millis"]
CLUSTERS = {"points": POINT_CLUSTER, "sessions": SESSION_CLUSTER, "time_tracking": TRACKING_CLUSTER}


def _cluster(rows: DataFrame, columns: list[str]) -> list[str] | None:
    """The clustering columns, where the table's schema has them all."""
    return columns if set(columns) <= set(rows.columns) else None


def _keep(lines: DataFrame) -> list[str]:
    return [c for c in ("day",) if c in lines.columns]


# ---- parsed lines: table columns, ``day``, reject reason, line ------------------

def parsed_points(lines: DataFrame, target: T.StructType | str | None = None) -> DataFrame:
    """Points, flattened and projected on the table schema (``target``: a
    schema or the path of a schema file; default: aggregated datasets)."""
    target = schema.table_schema(lines.sparkSession, target, schema.AGGREGATED_DATASETS)
    return flatten.flatten_project(lines, target, input_schema=POINT_LINE, keep=_keep(lines))


def parsed_sessions(lines: DataFrame, target: T.StructType | str | None = None) -> DataFrame:
    """Sessions as they were reported; the split needs both times, so a row
    without them is a reject."""
    target = schema.table_schema(lines.sparkSession, target, schema.SESSIONS,
                                 needs=("startTimeMillis", "endTimeMillis"))
    rows = flatten.flatten_project(lines, target, input_schema=SESSION_LINE, keep=_keep(lines))
    missing = F.col("startTimeMillis").isNull() | F.col("endTimeMillis").isNull()
    return rows.withColumn(flatten.REASON, F.coalesce(
        F.col(flatten.REASON), F.when(missing, F.lit("session without start/end"))))


def parsed_time_tracking(lines: DataFrame, target: T.StructType | str | None = None, *,
                         line_schema: T.StructType | None = None, any_key_spelling: bool = False) -> DataFrame:
    """Flat lines; ``(`` ``)`` dropped from names; productivity rule (not
    without a ``productivity`` column).

    Lines are parsed with the declared line schema (the keys the landing
    writes, both spellings of the seconds key); ``any_key_spelling`` switches
    to the generic map parse that accepts every key normalising to a column
    name, at about five times the parse cost.
    """
    target = schema.table_schema(lines.sparkSession, target, schema.TIME_TRACKING)
    ruled = "productivity" in target.names
    rows = flatten.flatten_project(lines, target,
                                   input_schema=None if any_key_spelling
                                   else (line_schema or TIME_TRACKING_LINE),
                                   drop_chars=flatten.BRACKETS_AND_PARENS,
                                   keep=_keep(lines), presence=["productivity"] if ruled else None)
    return flatten.apply_productivity(rows) if ruled else rows


def cut_sessions(good: DataFrame, lo=None, hi=None, step_ms: int = intervals.STEP_MS) -> DataFrame:
    """Sessions clipped to ``[lo, hi]`` (epoch ms or columns) and split into
    ``step_ms`` pieces."""
    if lo is not None and hi is not None:
        good = intervals.clip_intervals(good, "startTimeMillis", "endTimeMillis", lo, hi)
    return intervals.split_intervals(good, "startTimeMillis", "endTimeMillis", step_ms)


PARSED = {"points": parsed_points, "sessions": parsed_sessions, "time_tracking": parsed_time_tracking}


def point_rows(lines: DataFrame, target: T.StructType | str | None = None) -> tuple[DataFrame, DataFrame]:
    """B1 points branch: (rows, rejects)."""
    return flatten.split_rejects(parsed_points(lines, target))


def session_rows(lines: DataFrame, lo=None, hi=None, step_ms: int = intervals.STEP_MS,
                 target: T.StructType | str | None = None) -> tuple[DataFrame, DataFrame]:
    """B1 sessions branch: (clipped and split rows, rejects)."""
    good, rejects = flatten.split_rejects(parsed_sessions(lines, target))
    return cut_sessions(good, lo, hi, step_ms), rejects


def time_tracking_rows(lines: DataFrame, line_schema: T.StructType | None = None, any_key_spelling: bool = False,
                       target: T.StructType | str | None = None) -> tuple[DataFrame, DataFrame]:
    """B2: (rows, rejects)."""
    return flatten.split_rejects(parsed_time_tracking(lines, target, line_schema=line_schema,
                                                      any_key_spelling=any_key_spelling))


# ---- windows of a run ---------------------------------------------------------

@dataclass(frozen=True)
class DayWindow:
    day: _dt.date
    begin_ms: int
    end_ms: int


def day_window(day, end_inclusive_ms: int | None = None) -> DayWindow:
    """UTC day window: ``[00:00, next 00:00]`` by default; the original
    scripts used ``23:59:59.99`` as end (pass ``end_inclusive_ms``)."""
    d = timez.to_date_value(day)
    begin = timez.local_day_start_millis(d, "UTC")
    end = end_inclusive_ms if end_inclusive_ms is not None else begin + timez.MILLIS_PER_DAY
    return DayWindow(d, begin, end)


def text_window(begin: str, end: str) -> DayWindow:
    """Window between two RFC 3339 times, of the UTC day of its begin."""
    lo, hi = (_dt.datetime.fromisoformat(t) for t in (begin, end))
    if lo.tzinfo is None or hi.tzinfo is None:
        raise ValueError(f"times need an offset: {begin}, {end}")
    ms = _dt.timedelta(milliseconds=1)
    epoch = _dt.datetime(1970, 1, 1, tzinfo=_dt.timezone.utc)
    return DayWindow(lo.astimezone(_dt.timezone.utc).date(), (lo - epoch) // ms, (hi - epoch) // ms)


def reload_days(run_day, n_days: int = 2) -> list[DayWindow]:
    """A run for day ``ds`` reloads UTC days ``ds-n+1 … ds`` (late data and
    sessions reported on both days they touch are completed by the re-load)."""
    d = timez.to_date_value(run_day)
    return [day_window(d - _dt.timedelta(days=i)) for i in reversed(range(n_days))]


# ---- jobs ------------------------------------------------------------------------

@dataclass(frozen=True)
class Counts:
    """Lines that passed and lines that were rejected."""

    rows: int
    rejects: int


@dataclass(frozen=True)
class Staged:
    """Parsed rows, written once: all, the good ones, the rejects, their counts."""

    path: str
    rows: DataFrame
    good: DataFrame
    rejects: DataFrame
    counts: Counts

    def drop(self) -> None:
        """Delete the good rows; the few rejects stay with who holds them."""
        for kept in ("false", "__HIVE_DEFAULT_PARTITION__"):
            published.remove(self.good.sparkSession, f"{self.path}/_rejected={kept}")


def stage(rows: DataFrame, name: str, flag: Column | None = None) -> Staged:
    """Write parsed rows to the shared scratch folder, routed by whether they
    have a reject reason (or by ``flag``; where it is null, a row is neither
    good nor a reject).  This is the one pass over the raw lines; what comes
    after (layout, rejects) reads the staged columns.  Counts are observed
    during the write."""
    spark, path, seen = rows.sparkSession, scratch_path(rows.sparkSession, name), Observation()
    flag = F.col(flatten.REASON).isNotNull() if flag is None else flag
    (rows.withColumn("_rejected", flag)
     .observe(seen, F.count_if(~flag).alias("rows"), F.count_if(flag).alias("rejects"))
     .write.partitionBy("_rejected").parquet(path))
    back = spark.read.schema(T.StructType([*rows.schema.fields, T.StructField("_rejected", T.BooleanType())])).parquet(path)
    got = seen.get
    return Staged(path, back, back.filter("NOT _rejected").drop("_rejected"), back.filter("_rejected").drop("_rejected"),
                  Counts(got["rows"], got["rejects"]))


def _load(spark: SparkSession, lake_root: str, kind: str, table: str, windows: list[DayWindow],
          rejects_table: str | None, target: T.StructType | str | None, files: int | None) -> Counts:
    """One dataset: scan, parse once, stage, lay out, replace the days."""
    days = [w.day for w in windows]
    lines = lake.scan_jsonl(spark, lake_root, day=days, dataset=DATASETS[kind])
    staged = stage(PARSED[kind](lines, target), f"load-{kind}")
    good, _ = flatten.split_rejects(staged.good)
    _, rejects = flatten.split_rejects(staged.rejects)
    if kind == "sessions":
        def bound(pick) -> Column:
            return F.element_at(F.create_map(*[F.lit(x) for w in windows for x in (w.day, pick(w))]), F.col("day"))

        good = cut_sessions(good, bound(lambda w: w.begin_ms), bound(lambda w: w.end_ms))
    warehouse.load_days(rejects, warehouse.rejects_of(table, rejects_table, DATASETS[kind]), days)
    users.merge_users(good, table)
    warehouse.load_days(good, table, days, cluster_by=_cluster(good, CLUSTERS[kind]), files=files)
    published.remove(spark, staged.path)
    return staged.counts


def load_windows(spark: SparkSession, lake_root: str, tables: dict[str, str], windows: list[DayWindow],
                 rejects_table: str | None = None, schemas: dict[str, T.StructType | str] | None = None,
                 files: int | None = None) -> dict[str, Counts]:
    """B1 and B2 for several UTC days: each day of ``windows`` is replaced, also
    by nothing, and sessions are clipped to their own day's window.

    Tables are folders or names in the catalog.  The datasets are independent
    and loaded at the same time, one pass over the lines each.  Rejected lines
    are always kept (in ``rejects_table`` by dataset, else next to each table)
    and the counts returned.
    """
    schemas = schemas or {}

    def one(kind: str) -> Counts:
        return _load(spark, lake_root, kind, tables[kind], windows, rejects_table, schemas.get(kind), files)

    with ThreadPoolExecutor(max(len(tables), 1)) as pool:
        return dict(zip(tables, pool.map(inheritable_thread_target(spark)(one), tables)))


def job_load_fitness(spark: SparkSession, lake_root: str, points_table: str, sessions_table: str, window: DayWindow,
                     rejects_table: str | None = None, files: int | None = None,
                     points_schema: T.StructType | str | None = None,
                     sessions_schema: T.StructType | str | None = None) -> dict[str, Counts]:
    """B1 for one UTC day: both branches, each a truncate-load of the day.
    The schemas are those of the tables, given or as paths of schema files."""
    return load_windows(spark, lake_root, {"points": points_table, "sessions": sessions_table}, [window], rejects_table,
                        {"points": points_schema, "sessions": sessions_schema}, files)


def job_load_time_tracking(spark: SparkSession, lake_root: str, table: str, window: DayWindow,
                           rejects_table: str | None = None, files: int | None = None,
                           table_schema: T.StructType | str | None = None) -> Counts:
    """B2 for one UTC day (all users' lines of that day)."""
    return load_windows(spark, lake_root, {"time_tracking": table}, [window], rejects_table,
                        {"time_tracking": table_schema}, files)["time_tracking"]


def load_all_days(rows: DataFrame, table: str, cluster_by: list[str], files: int | None = None) -> None:
    """Many days in one job: rows carry ``day``; every day present is
    replaced, other days are left alone."""
    warehouse.load_days(rows, table, None, cluster_by=cluster_by, files=files)


def run_reload(spark: SparkSession, run_day, lake_root: str, tables: dict[str, str],
               rejects_table: str | None = None, *, windows: list[DayWindow] | None = None,
               schemas: dict[str, T.StructType | str] | None = None) -> dict[str, Counts]:
    """Re-load the run's days (or the given ``windows``) into the fitness
    and time-tracking tables."""
    return load_windows(spark, lake_root, tables, windows or reload_days(run_day), rejects_table, schemas)


# ---- landing (B3) ------------------------------------------------------------------

def land_documents(rows: DataFrame, lake_root: str, dataset: str, day_col: str = "day",
                   shards: int | None = None) -> None:
    """Parsed landing rows (with ``user_id`` and a day column) → lake JSONL,
    replacing exactly the (day, dataset) prefixes written."""
    data_cols = [c for c in rows.columns if c != day_col]
    # a user that is text stands in the line as it is
    user = "user_id" if dict(rows.dtypes).get("user_id") == "string" else None
    lines = rows.select(F.col(day_col).cast("date").alias("day"), F.lit(dataset).alias("dataset"),
                        lake.json_line(data_cols).alias("value"), *([user] if user else []))
    lake.write_sharded_jsonl(lines, lake_root, shards=shards, user_col=user)


# of each fitness dataset: envelope, the part that a document must have, lines
FITNESS = {
    "sessions": (landing.SESSIONS_RAW, "session", landing.session_lines),
    "points": (landing.AGGREGATED_RAW, "bucket", landing.aggregated_lines),
    "datasources": (landing.DATASOURCES_RAW, "dataSource", landing.datasource_lines),
    "raw_points": (landing.DATASETS_RAW, "point", landing.dataset_lines),
}


def _land(rows: DataFrame, kind: str, lake_root: str, day, *, user_id: str | None, shards: int | None,
          rejects_table: str | None) -> DataFrame:
    """Rows (``user_id``, ``file``, reject reason, ``value``) → lake, for the
    users they name: their lines of the day and dataset are replaced, also by
    nothing (a row of neither value nor reason), those of all other users stay.
    Answers are parsed once, into staged lines; the rejected ones come back
    (user, dataset, file, reason, text), and with ``rejects_table`` are kept in
    a lake of that root in the same way."""
    dataset, d, spark = DATASETS[kind], timez.to_date_value(day), rows.sparkSession
    bad = F.col(landing.REASON).isNotNull()
    staged = stage(rows.select("user_id", "file", landing.REASON, "value"), f"land-{kind}",
                   F.when(bad | F.col("value").isNotNull(), bad))
    landed = staged.rows.select(F.col("user_id").alias("user")).distinct() if user_id is None \
        else spark.createDataFrame([(user_id,)], "user string")
    lake.write_users(staged.good, lake_root, d, dataset, landed, shards, user_col="user_id")
    rejects = staged.rejects.select("user_id", F.lit(dataset).alias("dataset"), "file", landing.REASON,
                                    F.col("value").alias("text"))
    if rejects_table:
        lake.write_users(rejects.select("user_id", F.to_json(F.struct(
            "user_id", "file", F.col(landing.REASON).alias("reason"), "text")).alias("value")),
            rejects_table, d, dataset, landed, shards, user_col="user_id")
    staged.drop()
    return rejects


def land_answers(docs: DataFrame, kind: str, lake_root: str, day, *, user_id: str | None = None,
                 user_col: str | None = None, shards: int | None = None,
                 rejects_table: str | None = None) -> DataFrame:
    """B3 of one fitness dataset: parsed envelopes (``landing.parsed_once`` or
    ``read_envelopes`` with the envelope of ``FITNESS[kind]``) of one user
    (``user_id``) or many (``user_col``) → lake, see :func:`_land`.  Every key
    of an element is kept."""
    _, required, to_lines = FITNESS[kind]
    user_id = None if user_col is not None else user_id
    lines = to_lines(landing.marked_documents(docs, [required]), user_id=user_id, user_col=user_col)
    return _land(lines, kind, lake_root, day, user_id=user_id, shards=shards, rejects_table=rejects_table)


def land_matrices(docs: DataFrame, lake_root: str, day, *, load_tz, output_tz: str = "UTC", user_id: str | None = None,
                  user_col: str | None = None, shards: int | None = None,
                  rejects_table: str | None = None) -> DataFrame:
    """B3 for time tracking: parsed matrix answers → rows of ``day`` (in
    ``output_tz``) → lake, as :func:`land_answers`.  A rejected row comes back
    with its cells as text."""
    good, bad_docs = landing.split_documents(docs, ["row_headers", "rows"])
    rows = landing.parse_matrix(good, load_tz=load_tz, output_date=day, output_tz=output_tz, user_id=user_id,
                                user_col=user_col)
    none = F.lit(None).cast("string")
    user = F.lit(user_id).cast("string") if user_col is None else F.col(user_col).cast("string")
    file = F.col("_file") if "_file" in docs.columns else none
    rows = rows.select("user_id", none.alias("file"), landing.REASON,
                       F.coalesce(F.col("_line"), landing.matrix_json(rows)).alias("value"))
    rows = rows.union(bad_docs.select(user, file, F.lit("document"), F.col(landing.TEXT)))
    # a user without rows of the day is landed too
    rows = rows.union(docs.select(user, none, none, none).distinct())
    return _land(rows, "time_tracking", lake_root, day, user_id=None if user_col is not None else user_id,
                 shards=shards, rejects_table=rejects_table)


def _land_fitness(spark: SparkSession, paths: dict[str, str | None], lake_root: str, day,
                  user_id: str | None, shards: int | None, rejects_table: str | None) -> DataFrame:
    rejects = None
    for kind, path in paths.items():
        if path is None:
            continue
        docs = landing.read_envelopes(spark, path, FITNESS[kind][0])
        user_col = None
        if user_id is None:
            docs, user_col = docs.withColumn("__user", landing.user_from_path()), "__user"
        got = land_answers(docs, kind, lake_root, day, user_id=user_id, user_col=user_col,
                           shards=shards, rejects_table=rejects_table)
        rejects = got if rejects is None else rejects.unionByName(got)
    return rejects


def job_land_fitness(spark: SparkSession, sessions_path: str, aggregated_path: str,
                     lake_root: str, day, user_id: str, shards: int | None = None, *,
                     datasources_path: str | None = None, raw_points_path: str | None = None,
                     rejects_table: str | None = None) -> DataFrame:
    """B3 for one user and day: saved answers → lake; other users' lines stay.
    Returns the rejected documents and elements."""
    return _land_fitness(spark, {"sessions": sessions_path, "points": aggregated_path,
                                 "datasources": datasources_path, "raw_points": raw_points_path},
                         lake_root, day, user_id, shards, rejects_table)


def job_land_time_tracking(spark: SparkSession, docs_path: str, lake_root: str, day,
                           user_id: str, load_tz: str, output_tz: str = "UTC",
                           shards: int | None = None, rejects_table: str | None = None) -> DataFrame:
    """B3 for time tracking of one user.  Returns the rejected rows."""
    docs = landing.read_envelopes(spark, docs_path, landing.MATRIX_ENVELOPE)
    return land_matrices(docs, lake_root, day, load_tz=load_tz, output_tz=output_tz, user_id=user_id, shards=shards,
                         rejects_table=rejects_table)


def job_land_time_tracking_users(spark: SparkSession, docs_root: str, lake_root: str, day,
                                 user_zones: DataFrame, output_tz: str = "UTC",
                                 shards: int | None = None, rejects_table: str | None = None) -> DataFrame:
    """B3 for many users in one job: saved answers under
    ``<docs_root>/user=<id>/…`` → rows of UTC ``day`` → lake.

    Each user's export is read in that user's zone, taken from
    ``user_zones(user_id, tz)`` — a join on ``user_id`` with one row per
    answer document on the left, so its size follows the number of
    documents, not rows.  A user listed more than once counts once, with the
    first zone by name.  Returns the rejected rows (unknown users included).
    """
    docs = landing.read_envelopes(spark, docs_root, landing.MATRIX_ENVELOPE)
    docs = docs.withColumn("user_id", landing.user_from_path())
    zones = user_zones.groupBy("user_id").agg(F.min("tz").alias("__tz"))
    return land_matrices(docs.join(zones, "user_id", "left"), lake_root, day, load_tz=F.col("__tz"), output_tz=output_tz,
                         user_col="user_id", shards=shards, rejects_table=rejects_table)


def job_land_fitness_users(spark: SparkSession, sessions_root: str, aggregated_root: str,
                           lake_root: str, day, shards: int | None = None, *,
                           datasources_root: str | None = None, raw_points_root: str | None = None,
                           rejects_table: str | None = None) -> DataFrame:
    """B3 for many users in one job: answers under ``<root>/user=<id>/…`` →
    lake, user from the folder.  Returns the rejected documents and elements."""
    return _land_fitness(spark, {"sessions": sessions_root, "points": aggregated_root,
                                 "datasources": datasources_root, "raw_points": raw_points_root},
                         lake_root, day, None, shards, rejects_table)
