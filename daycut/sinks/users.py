"""User dimension of a warehouse table: first and last UTC day of each user.

Kept next to the table (``<table>_users``) and merged by every load, so a
per-user report finds its users without a scan of all facts.  A user stays
listed when a reload takes the user's last rows away.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daycut.session import checkpointed
from daycut.sinks import published, warehouse

#: The one day partition that the dimension is replaced in.
_SLOT = _dt.date(1970, 1, 1)


def users_of(table: str) -> str:
    return f"{table.rstrip('/')}_users"


def read_users(spark: SparkSession, table: str) -> DataFrame | None:
    """``user_id``, ``first_day``, ``last_day`` of the table's users; None if
    no load has kept them."""
    name = users_of(table)
    if warehouse.named(name):
        if not spark.catalog.tableExists(name):
            return None
    elif published.current(spark, name) is None:
        return None
    return warehouse.read_table(spark, name).select("user_id", "first_day", "last_day")


def merge_users(rows: DataFrame, table: str) -> None:
    """Add the users of loaded ``rows`` (``user_id``, ``day``); nothing to do
    for a table without a user column."""
    if "user_id" not in rows.columns:
        return
    spark = rows.sparkSession
    new = rows.groupBy("user_id").agg(F.min("day").alias("first_day"), F.max("day").alias("last_day"))
    old = read_users(spark, table)
    both = new if old is None else old.unionByName(new)
    merged = both.groupBy("user_id").agg(F.min("first_day").alias("first_day"), F.max("last_day").alias("last_day"))
    if warehouse.named(table):                  # INSERT OVERWRITE cannot read what it replaces
        merged = checkpointed(merged)
    warehouse.load_partition(merged, users_of(table), _SLOT)
