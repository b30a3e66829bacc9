"""Warehouse tables derived from the generic ``events`` table.

The test tables do not contain fitness or time-tracking exports, so the three
warehouse tables are derived from ``events`` row by row (no shuffle):

* points      (aggregated_datasets): one point per event
* sessions    : one session per event, length ``value`` minutes
* activities  (time_tracking): one tracked activity per event

``events.ts`` is TIMESTAMP_NTZ holding UTC wall time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daycut.functions import labels, timez

# ---- fixed stand-in mapping of event types ---------------------------------
STEP_TYPE = "com.google.step_count.delta"
DISTANCE_TYPE = "com.google.distance.delta"
CALORIES_TYPE = "com.google.calories.expended"
HEART_RATE_TYPE = "com.google.heart_rate.summary"
ACTIVE_MINUTES_TYPE = "com.google.active_minutes"

EVENT_DATA_TYPES = {
    "click": STEP_TYPE,
    "view": DISTANCE_TYPE,
    "purchase": CALORIES_TYPE,
    "signup": HEART_RATE_TYPE,
    "error": ACTIVE_MINUTES_TYPE,
}
EVENT_ACTIVITY_TYPES = {"click": 72, "view": 109, "purchase": 7,
                        "signup": 111, "error": 3}
# ----------------------------------------------------------------------------

def read_events(spark: SparkSession, sf_dir: str, spread_rows: bool = False) -> DataFrame:
    """The events table.

    With ``spread_rows`` an under-split table is spread over the cluster: a
    single small file (one Parquet row group) would otherwise run every
    row-wise step before the first shuffle in one task.  Worth it only for
    heavy row-wise work (JSON building and parsing); a table of many files is
    never touched.
    """
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")
    return spread(df) if spread_rows else df


def spread(df: DataFrame) -> DataFrame:
    """Round-robin over the cluster, whatever the input's splits."""
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)


def _lookup(mapping: dict, key):
    pairs = []
    for k, v in mapping.items():
        pairs += [F.lit(k), F.lit(v)]
    return F.try_element_at(F.create_map(*pairs), key)


def _k(events_props="props"):
    return F.get_json_object(F.col(events_props), "$.k").cast("long")


def _start_ms():
    return timez.instant_millis(timez.ntz_to_instant("ts"))


def points_from_events(events: DataFrame, carry: tuple = ()) -> DataFrame:
    """aggregated_datasets rows: ns times, one value of each kind.
    ``carry`` names extra input columns to pass through."""
    start_ns = F.unix_micros(timez.ntz_to_instant("ts")) * F.lit(1000)
    return events.select(
        *carry,
        F.col("user_id").cast("string").alias("user_id"),
        F.concat(F.lit("derived:"), F.col("event_type")).alias("dataSourceId"),
        start_ns.alias("startTimeNanos"),
        (start_ns + F.lit(60_000_000_000)).alias("endTimeNanos"),
        _lookup(EVENT_DATA_TYPES, F.col("event_type")).alias("dataTypeName"),
        F.col("value").alias("value0_fpVal"),
        _k().alias("value0_intVal"),
    )


def sessions_from_events(events: DataFrame, carry: tuple = ()) -> DataFrame:
    """sessions rows: ms times, ``value`` minutes long, app by user."""
    start = _start_ms()
    end = start + timez.round_long(F.col("value") * F.lit(60000))
    activity = _lookup(EVENT_ACTIVITY_TYPES, F.col("event_type")).cast("long")
    return events.select(
        *carry,
        F.col("user_id").cast("string").alias("user_id"),
        F.col("event_id").cast("string").alias("id"),
        F.col("event_type").alias("name"),
        start.alias("startTimeMillis"),
        end.alias("endTimeMillis"),
        end.alias("modifiedTimeMillis"),
        F.concat(F.lit("app"), F.pmod(F.col("user_id"), F.lit(3)).cast("string"))
         .alias("application_packageName"),
        activity.alias("activityType"),
        labels.activity_type_label(activity).alias("activityType_String"),
    )


def activities_from_events(events: DataFrame) -> DataFrame:
    """time_tracking rows: ms time, seconds spent, productivity -2..2."""
    code = (F.pmod(F.col("event_id"), F.lit(5)) - F.lit(2)).cast("long")
    k = _k()
    return events.select(
        F.col("user_id").cast("string").alias("user_id"),
        _start_ms().alias("date_timestamp_millis"),
        k.alias("time_spent_seconds"),
        F.concat(F.lit("a"), k.cast("string")).alias("activity"),
        F.col("event_type").alias("category"),
        labels.productivity_label(code).alias("productivity_string"),
        code.alias("productivity"),
    )


# SQL text of the same derivations, for the DuckDB oracle (views on events).
ORACLE_POINTS = """
  SELECT event_id // 1000 AS page, CAST(user_id AS VARCHAR) AS user_id,
         'derived:' || event_type AS dataSourceId,
         epoch_us(ts) * 1000 AS startTimeNanos,
         epoch_us(ts) * 1000 + 60000000000 AS endTimeNanos,
         CASE event_type WHEN 'click' THEN 'com.google.step_count.delta'
                         WHEN 'view' THEN 'com.google.distance.delta'
                         WHEN 'purchase' THEN 'com.google.calories.expended'
                         WHEN 'signup' THEN 'com.google.heart_rate.summary'
                         WHEN 'error' THEN 'com.google.active_minutes' END AS dataTypeName,
         value AS value0_fpVal,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS value0_intVal
  FROM events"""

ORACLE_SESSIONS = """
  SELECT event_id // 1000 AS page, CAST(user_id AS VARCHAR) AS user_id,
         CAST(event_id AS VARCHAR) AS id,
         event_type AS name,
         epoch_us(ts) // 1000 AS startTimeMillis,
         epoch_us(ts) // 1000 + CAST(round(value * 60000) AS BIGINT) AS endTimeMillis,
         epoch_us(ts) // 1000 + CAST(round(value * 60000) AS BIGINT) AS modifiedTimeMillis,
         'app' || CAST(user_id % 3 AS VARCHAR) AS application_packageName,
         CAST(CASE event_type WHEN 'click' THEN 72 WHEN 'view' THEN 109
                              WHEN 'purchase' THEN 7 WHEN 'signup' THEN 111
                              WHEN 'error' THEN 3 END AS BIGINT) AS activityType,
         CASE event_type WHEN 'click' THEN 'Sleeping' WHEN 'purchase' THEN 'Walking*'
                         END AS activityType_String
  FROM events"""

ORACLE_ACTIVITIES = """
  SELECT CAST(user_id AS VARCHAR) AS user_id,
         epoch_us(ts) // 1000 AS date_timestamp_millis,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS time_spent_seconds,
         'a' || json_extract_string(props, '$.k') AS activity,
         event_type AS category,
         CASE event_id % 5 - 2 WHEN -2 THEN 'very distracting' WHEN -1 THEN 'distracting'
              WHEN 0 THEN 'neutral' WHEN 1 THEN 'productive'
              WHEN 2 THEN 'very productive' END AS productivity_string,
         CAST(event_id % 5 - 2 AS BIGINT) AS productivity
  FROM events"""
