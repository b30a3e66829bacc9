"""API answers and lake lines derived from ``events`` (inputs of the landing
and load queries).

Documents are built with ``collect_list`` per (user, page) where a page holds
the events of one block of ``PAGE_EVENTS`` consecutive event ids: a document,
like an API page, never holds more than that many items, whatever the skew
of users or days.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daycut.functions import timez
from daycut.plans import standins

# ---- fixed values -------------------------------------------------------------
PAGE_EVENTS = 1000
# events of a table for each task that makes documents
TASK_EVENTS = 100_000
# two headers normalise to one name: the later one counts
MATRIX_HEADERS = ["Date", "Time Spent (seconds)", "ACTIVITY", "Activity", "Category", "Productivity"]
LOAD_TZ = "Asia/Seoul"
CIVIL_FORMAT = "yyyy-MM-dd'T'HH:mm:ss"
# --------------------------------------------------------------------------------


def _page(event_id="event_id"):
    return F.floor(F.col(event_id) / F.lit(PAGE_EVENTS)).cast("long")


def _s(c):
    return F.col(c).cast("string")


def _point_struct():
    return F.struct(
        _s("startTimeNanos").alias("startTimeNanos"),
        _s("endTimeNanos").alias("endTimeNanos"),
        F.col("dataTypeName"),
        # a key that no schema of the landing names
        timez.nanos_to_millis("startTimeNanos").cast("string").alias("computationTimeMillis"),
        F.array(F.struct(F.col("value0_fpVal").alias("fpVal"),
                         F.col("value0_intVal").alias("intVal"))).alias("value"))


def document_tasks(events: DataFrame) -> int:
    """Tasks to make documents in, for ``tasks=``: more for a larger table."""
    return max(events.sparkSession.sparkContext.defaultParallelism, -(-events.count() // TASK_EVENTS))


def session_documents(events: DataFrame, tasks: int | None = None) -> DataFrame:
    """``{"session": [...]}`` per (user, page); times as strings.

    With ``tasks`` the events themselves are dealt by (user, page) over that
    many tasks, whatever the input's splits: a row of a few numbers crosses the
    exchange instead of its session, and the documents are made where it ends.
    """
    paged = events.select("*", _page().alias("page"))
    if tasks:
        # under the name and type that the documents are grouped by
        paged = paged.withColumn("user_id", _s("user_id")).repartition(tasks, "user_id", "page")
    s = standins.sessions_from_events(paged, carry=("page",))
    item = F.struct(
        F.col("id"), F.col("name"),
        _s("startTimeMillis").alias("startTimeMillis"),
        _s("endTimeMillis").alias("endTimeMillis"),
        _s("modifiedTimeMillis").alias("modifiedTimeMillis"),
        F.struct(F.col("application_packageName").alias("packageName")).alias("application"),
        (F.col("endTimeMillis") - F.col("startTimeMillis")).cast("string").alias("activeTimeMillis"),
        F.col("activityType"))
    # groups of texts: cheaper to hold and to merge than groups of structs
    docs = s.select("user_id", "page", F.to_json(item).alias("item")) \
        .groupBy("user_id", "page").agg(F.concat_ws(",", F.collect_list("item")).alias("session"))
    return docs.select("user_id", "page", F.concat(F.lit('{"session":['), "session", F.lit("]}")).alias("value"))


def _points_paged(events: DataFrame) -> DataFrame:
    return standins.points_from_events(events.select("*", _page().alias("page")),
                                       carry=("page",))


def aggregated_documents(events: DataFrame) -> DataFrame:
    """``{"bucket": [{start, end, "dataset": [{dataSourceId, "point": [...]}]}]}``
    per (user, page), buckets of 30 minutes."""
    p = _points_paged(events)
    # one exchange serves the three groupings
    p = p.repartition("user_id", "page")
    ms = timez.nanos_to_millis("startTimeNanos")
    p = p.withColumn("bstart", F.floor(ms / F.lit(1_800_000)).cast("long") * F.lit(1_800_000))
    ds = p.groupBy("user_id", "page", "bstart", "dataSourceId") \
          .agg(F.collect_list(_point_struct()).alias("point"))
    bk = ds.groupBy("user_id", "page", "bstart").agg(
        F.collect_list(F.struct("dataSourceId", "point")).alias("dataset"))
    bucket = F.struct(_s("bstart").alias("startTimeMillis"),
                      (F.col("bstart") + F.lit(1_800_000)).cast("string").alias("endTimeMillis"),
                      F.col("dataset"))
    docs = bk.groupBy("user_id", "page").agg(F.collect_list(bucket).alias("bucket"))
    return docs.select("user_id", "page", F.to_json(F.struct("bucket")).alias("value"))


def dataset_documents(events: DataFrame) -> DataFrame:
    """Raw-point answers per (user, source, page) with min/max times."""
    p = _points_paged(events)
    docs = p.groupBy("user_id", "dataSourceId", "page").agg(
        F.min("startTimeNanos").cast("string").alias("minStartTimeNs"),
        F.max("endTimeNanos").cast("string").alias("maxEndTimeNs"),
        F.collect_list(_point_struct()).alias("point"))
    return docs.select("user_id", "page", F.to_json(
        F.struct("minStartTimeNs", "maxEndTimeNs", "dataSourceId", "point")).alias("value"))


def datasource_documents(events: DataFrame) -> DataFrame:
    """``{"dataSource": [...]}`` per user (a handful of sources each)."""
    src = events.select(F.col("user_id").cast("string").alias("user_id"),
                        F.struct(F.concat(F.lit("derived:"), F.col("event_type"))
                                 .alias("dataStreamId"),
                                 F.col("event_type").alias("dataStreamName"),
                                 F.lit("derived").alias("type"),
                                 F.concat(F.lit("v-"), F.col("event_type")).alias("vendor"))
                        .alias("s"))
    docs = src.groupBy("user_id").agg(F.collect_set("s").alias("dataSource"))
    return docs.select("user_id", F.to_json(F.struct("dataSource")).alias("value"))


def civil_time(tz: str = LOAD_TZ):
    return F.date_format(timez.local_ts(timez.ntz_to_instant("ts"), tz), CIVIL_FORMAT)


def matrix_documents(events: DataFrame) -> DataFrame:
    """Time-tracking answers: header + rows per (user, local day, page), rows
    in the user's zone; ``local_day`` is kept for choosing output days."""
    code = (F.pmod(F.col("event_id"), F.lit(5)) - F.lit(2)).cast("string")
    k = F.get_json_object(F.col("props"), "$.k")
    row = F.array(civil_time(), k, F.lit("earlier"), F.concat(F.lit("a"), k), F.col("event_type"), code)
    ev = events.select(F.col("user_id").cast("string").alias("user_id"), _page().alias("page"),
                       timez.local_date(timez.ntz_to_instant("ts"), LOAD_TZ).alias("local_day"),
                       row.alias("r"))
    docs = ev.groupBy("user_id", "local_day", "page").agg(F.collect_list("r").alias("rows"))
    headers = F.array(*[F.lit(h) for h in MATRIX_HEADERS])
    return docs.select("user_id", "local_day", "page",
                       F.to_json(F.struct(headers.alias("row_headers"), F.col("rows")))
                       .alias("value"))


def time_tracking_lines(events: DataFrame) -> DataFrame:
    """Lake lines as the landing writes them, with productivity codes -3..3
    (so ±3 are rejects) and the ``time_spent_(seconds)`` header key."""
    code = (F.pmod(F.col("event_id"), F.lit(7)) - F.lit(3)).cast("string")
    k = F.get_json_object(F.col("props"), "$.k")
    ms = timez.instant_millis(timez.ntz_to_instant("ts"))
    obj = F.struct(F.col("user_id").cast("string").alias("user_id"),
                   civil_time().alias("date"),
                   ms.cast("string").alias("date_timestamp_millis"),
                   k.alias("time_spent_(seconds)"),
                   F.concat(F.lit("a"), k).alias("activity"),
                   F.col("event_type").alias("category"),
                   code.alias("productivity"))
    return events.select(F.to_date(timez.ntz_to_instant("ts")).alias("day"),
                         F.col("user_id").cast("string").alias("user"),
                         F.to_json(obj).alias("value"))
