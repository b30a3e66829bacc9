"""Declared table schemas: the JSON schema-file format and the three tables.

A schema file is ``{"name": …, "fields": [{"name", "type", "description"}]}``;
only ``name`` and ``type`` matter and every column is nullable.  Unlike a
silent fallback to an empty schema, a missing or broken file raises.
"""

from __future__ import annotations

import json

from pyspark.errors import PySparkException
from pyspark.sql import SparkSession
from pyspark.sql import types as T

# ---- fixed values: type names of the schema files and their Spark types -----
TYPE_NAMES = {
    "STRING": T.StringType(),
    "INT64": T.LongType(),
    "INTEGER": T.LongType(),
    "FLOAT64": T.DoubleType(),
    "FLOAT": T.DoubleType(),
    "BOOL": T.BooleanType(),
    "BOOLEAN": T.BooleanType(),
    "DATE": T.DateType(),
    "TIMESTAMP": T.TimestampType(),
}

# ---- fixed values: the warehouse tables (column name, type name) ------------
AGGREGATED_DATASETS_FIELDS = [
    ("user_id", "STRING"),
    ("dataSourceId", "STRING"),
    ("startTimeNanos", "INT64"),
    ("endTimeNanos", "INT64"),
    ("dataTypeName", "STRING"),
    ("value0_fpVal", "FLOAT64"),
    ("value0_intVal", "INT64"),
]
SESSIONS_FIELDS = [
    ("user_id", "STRING"),
    ("id", "STRING"),
    ("name", "STRING"),
    ("startTimeMillis", "INT64"),
    ("endTimeMillis", "INT64"),
    ("modifiedTimeMillis", "INT64"),
    ("application_packageName", "STRING"),
    ("activityType", "INT64"),
    ("activityType_String", "STRING"),
]
TIME_TRACKING_FIELDS = [
    ("user_id", "STRING"),
    ("date_timestamp_millis", "INT64"),
    ("time_spent_seconds", "INT64"),
    ("activity", "STRING"),
    ("category", "STRING"),
    ("productivity_string", "STRING"),
    ("productivity", "INT64"),
]
# ------------------------------------------------------------------------------


class SchemaError(ValueError):
    pass


def struct_from_fields(fields) -> T.StructType:
    out = []
    for name, type_name in fields:
        t = TYPE_NAMES.get(str(type_name).upper())
        if t is None:
            raise SchemaError(f"unknown column type {type_name!r} for {name!r}")
        out.append(T.StructField(name, t, True))
    return T.StructType(out)


def parse_schema_json(text: str) -> T.StructType:
    try:
        doc = json.loads(text)
        fields = [(f["name"], f["type"]) for f in doc["fields"]]
    except (ValueError, KeyError, TypeError) as ex:
        raise SchemaError(f"not a schema document: {ex}") from ex
    if not fields:
        raise SchemaError("schema has no fields")
    return struct_from_fields(fields)


def load_schema(path: str, spark: SparkSession | None = None) -> T.StructType:
    """Read a schema file (driver side; the file is a few hundred bytes), with
    a session from any file system that Spark reads."""
    try:
        if spark is not None:
            found = spark.read.text(path, wholetext=True).head()
            text = found[0] if found else ""
        else:
            with open(path, encoding="utf-8") as fh:
                text = fh.read()
    except (OSError, PySparkException) as ex:
        raise SchemaError(f"cannot read schema {path}: {ex}") from ex
    return parse_schema_json(text)


def table_schema(spark: SparkSession, given: T.StructType | str | None, default: T.StructType,
                 needs: tuple[str, ...] = ()) -> T.StructType:
    """A load's table schema: the default, a given one, or the file of a path.
    Raises where a column that the load ``needs`` is not in it."""
    out = default if given is None else load_schema(given, spark) if isinstance(given, str) else given
    lacking = [n for n in needs if n not in out.names]
    if lacking:
        raise SchemaError(f"schema lacks {', '.join(lacking)}")
    return out


def schema_json(name: str, fields) -> str:
    """Write a schema in the file format (for tests and new tables)."""
    return json.dumps({"name": name,
                       "fields": [{"name": n, "type": t} for n, t in fields]})


AGGREGATED_DATASETS = struct_from_fields(AGGREGATED_DATASETS_FIELDS)
SESSIONS = struct_from_fields(SESSIONS_FIELDS)
TIME_TRACKING = struct_from_fields(TIME_TRACKING_FIELDS)
