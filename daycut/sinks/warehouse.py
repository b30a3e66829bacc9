"""Warehouse tables: Parquet day partitions, laid out by user and time.

A table is a folder (a published list says which load holds each day, see
``published``) or a name in the session's catalog (day partitions are replaced
by INSERT OVERWRITE).  ``load_days`` replaces days (K3), also by nothing, at
once: a load that fails midway leaves the days as they were.

Layout (K4): rows are dealt by sampled ranges of (day, user, time) and sorted
by them, so the files of a day hold disjoint user ranges, whose min/max skip
files on a user filter; a user that holds a large share of the rows is cut by
time into as many files.  Bloom filters on the user skip the rest.  Sampling
reads the input twice: the load jobs lay out parsed, staged rows, never raw
lines.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daycut.sinks import published

DAY_COL = "day"
#: Distinct users of a row group that its bloom filter is sized for.
BLOOM_USERS = 100_000


def named(table: str) -> bool:
    """Whether ``table`` is a name in the catalog and no path."""
    return "/" not in table


def clustered(df: DataFrame, cluster_by: list[str], files: int | None = None,
              lead: list[str] | None = None) -> DataFrame:
    """Sampled ranges of ``lead`` + ``cluster_by`` (``[user_col, time_col]``),
    sorted inside.  Without ``files`` AQE merges neighbouring small ranges."""
    keys = [*(lead or []), *cluster_by]
    out = df.repartitionByRange(files, *keys) if files else df.repartitionByRange(*keys)
    return out.sortWithinPartitions(*keys)


def _days(days) -> list[str]:
    return [f"{d}" for d in days]


def _in_days(days: list[str]) -> Column:
    return F.col(DAY_COL).isin(*[F.lit(d).cast("date") for d in days])


def _bloom(cluster_by: list[str] | None) -> dict[str, str]:
    if not cluster_by:
        return {}
    return {f"parquet.bloom.filter.enabled#{cluster_by[0]}": "true",
            f"parquet.bloom.filter.expected.ndv#{cluster_by[0]}": f"{BLOOM_USERS}"}


def load_days(rows: DataFrame, table: str, days: list | None, *, cluster_by: list[str] | None = None,
              files: int | None = None) -> None:
    """Replace UTC days of a table by ``rows`` (which carry ``day``).

    ``days`` lists the days to replace, also by nothing; rows of other days
    are left out.  Without it, the days that get rows are replaced.
    """
    rows = rows.withColumn(DAY_COL, F.col(DAY_COL).cast("date"))
    out = rows if days is None else rows.filter(_in_days(_days(days)))
    if cluster_by:
        out = clustered(out, cluster_by, files, lead=[DAY_COL])
    if named(table):
        return _insert(out, table, days, cluster_by)
    spark, load, data = rows.sparkSession, published.new_load(), rows.drop(DAY_COL).schema
    out.write.options(**_bloom(cluster_by)).partitionBy(DAY_COL).parquet(published.load_path(table, load))
    held = {dict(key)[DAY_COL]: n for key, n in published.written(spark, table, load, data, "parquet").items()}
    # a list without any day still tells the columns
    replaced = sorted(held) if days is None else _days(days)
    published.publish(spark, table, [published.Slot(load, d, files=held.get(d, 0), columns=data.json())
                                     for d in replaced or [""]])


def load_partition(df: DataFrame, table: str, day, *, cluster_by: list[str] | None = None,
                   files: int | None = None) -> None:
    """Replace one UTC ``day`` of ``table`` by the rows."""
    load_days(df.withColumn(DAY_COL, F.lit(f"{day}").cast("date")), table, [day], cluster_by=cluster_by, files=files)


def _insert(rows: DataFrame, table: str, days: list | None, cluster_by: list[str] | None) -> None:
    """INSERT OVERWRITE of the day partitions of a table in the catalog, which
    is made where absent; days without rows are dropped.  Row counts and sizes
    of the replaced partitions go to the catalog's statistics."""
    spark = rows.sparkSession
    columns = [c for c in rows.columns if c != DAY_COL] + [DAY_COL]
    if not spark.catalog.tableExists(table):
        (rows.limit(0).select(*columns).write.format("parquet").partitionBy(DAY_COL)
         .options(**_bloom(cluster_by)).saveAsTable(table))
    into = spark.table(table).columns                       # INSERT goes by position
    held = {f"{r[0]}" for r in spark.sql(f"SHOW PARTITIONS {table}").selectExpr("substring(partition, 5)").collect()}
    rows.select(*into).write.option("partitionOverwriteMode", "dynamic").insertInto(table, overwrite=True)
    now = {f"{r[0]}" for r in spark.sql(f"SHOW PARTITIONS {table}").selectExpr("substring(partition, 5)").collect()}
    if days is not None:
        got = {f"{r[0]}" for r in rows.select(DAY_COL).distinct().collect()} if held & set(_days(days)) else now
        for day in sorted((held & set(_days(days))) - got):
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({DAY_COL} = DATE'{day}')")
    for day in sorted(now if days is None else now & set(_days(days))):
        if spark.sql(f"SHOW PARTITIONS {table} PARTITION ({DAY_COL} = DATE'{day}')").count():
            spark.sql(f"ANALYZE TABLE {table} PARTITION ({DAY_COL} = DATE'{day}') COMPUTE STATISTICS")


def read_table(spark: SparkSession, table: str, days: list | None = None) -> DataFrame:
    """A warehouse table with its ``day`` partition column (S8), by the path
    of its folder or by its name in the session's catalog.

    By path, the rows are those of the days as they are now (a later load does
    not change a frame made before); ``days`` lists only these.
    """
    if named(table):
        rows = spark.read.table(table)
        return rows if days is None else rows.filter(_in_days(_days(days)))
    slots = published.current(spark, table)
    if slots is None:
        rows = spark.read.option("basePath", table).parquet(table)      # a plain partitioned folder
        return rows if days is None else rows.filter(_in_days(_days(days)))
    newest = max(slots, key=lambda s: s.load)
    data = T.StructType.fromJson(json.loads(newest.columns))
    day = T.StructField(DAY_COL, T.DateType())
    folders = published.paths(table, [s for s in slots if days is None or s.day in _days(days)])
    if not folders:
        return spark.createDataFrame([], T.StructType([*data.fields, day]))
    whole = T.StructType([*data.fields, T.StructField("load", T.StringType()), day])
    rows = spark.read.schema(whole).option("basePath", table.rstrip("/")).parquet(*folders)
    return rows.drop("load")


def rejects_of(table: str, rejects_table: str | None, dataset: str) -> str:
    """Where the rejects of a load go: ``rejects_table`` by dataset, or next
    to the table."""
    if rejects_table is None:
        return f"{table.rstrip('/')}_rejects"
    return f"{rejects_table}_{dataset.replace('-', '_')}" if named(rejects_table) \
        else f"{rejects_table.rstrip('/')}/dataset={dataset}"
