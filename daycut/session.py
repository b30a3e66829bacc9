"""SparkSession settings the library relies on, and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# Settings every job of the library assumes.  Time arithmetic is done on
# epoch integers and on TIMESTAMP values interpreted in UTC; zones are applied
# explicitly with from_utc_timestamp/to_utc_timestamp.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # a day-partition load replaces only the partitions it writes
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(master: str | None = None, app_name: str = "daycut",
                  shuffle_partitions: int | None = None,
                  extra_conf: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the library's required settings.

    On a cluster leave ``master`` empty and size ``shuffle_partitions`` to the
    data (roughly input bytes / 128 MB); AQE coalesces what turns out small.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(REQUIRED_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    apply_conf(spark, shuffle_partitions)
    return spark


def apply_conf(spark: SparkSession, shuffle_partitions: int | None = None) -> None:
    """Apply the runtime-settable required settings to an existing session."""
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)
    if shuffle_partitions:
        spark.conf.set("spark.sql.shuffle.partitions", str(shuffle_partitions))


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Where the setting is absent (tests, local runs) a folder below the
    session's warehouse takes its place: executors share the warehouse too.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_daycut_scratch"
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint folder."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/daycut-scratch/{name}-{uuid.uuid4().hex[:12]}"


def checkpointed(df):
    """``df.checkpoint()`` into the shared folder named by
    ``spark.checkpoint.dir`` (reliable: survives executor loss, cuts lineage)."""
    spark = df.sparkSession
    root = checkpoint_root(spark).rstrip("/")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(f"{root}/daycut-rdd")
    return df.checkpoint(eager=True)
