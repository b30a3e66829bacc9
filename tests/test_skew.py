"""One user (or one prefix) holding most rows must not land in one task."""

import glob
import os

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from daycut.sinks import lake, warehouse


def _hot_rows(spark, n_hot=60_000, n_cold=20_000):
    hot = spark.range(n_hot).select(F.lit("hot").alias("user_id"),
                                    (F.lit(1_704_067_200_000) + F.col("id") * 1000)
                                    .alias("t"))
    cold = spark.range(n_cold).select(F.concat(F.lit("u"), (F.col("id") % 500).cast("string"))
                                      .alias("user_id"),
                                      (F.lit(1_704_067_200_000) + F.col("id") * 7000).alias("t"))
    return hot.unionByName(cold)


def _ranges(table, column):
    """(min, max, rows) of a column per file, from the files' statistics."""
    out = []
    for name in glob.glob(f"{table}/load=*/day=*/*.parquet"):
        meta = pq.ParquetFile(name).metadata
        at = meta.schema.to_arrow_schema().get_field_index(column)
        stats = [meta.row_group(g).column(at).statistics for g in range(meta.num_row_groups)]
        out.append((min(s.min for s in stats), max(s.max for s in stats), meta.num_rows))
    return out


def test_clustering_cuts_a_hot_user_by_time(spark):
    rows = _hot_rows(spark)
    laid = warehouse.clustered(rows, ["user_id", "t"], files=8)
    parts = laid.groupBy(F.spark_partition_id().alias("p"), (F.col("user_id") == "hot").alias("hot")) \
        .agg(F.count(F.lit(1)).alias("n"), F.min("t").alias("lo"), F.max("t").alias("hi")).collect()
    sizes = {}
    for r in parts:
        sizes[r.p] = sizes.get(r.p, 0) + r.n
    assert len(sizes) == 8 and max(sizes.values()) < 2.0 * (sum(sizes.values()) / len(sizes))
    hot = sorted((r.lo, r.hi) for r in parts if r.hot)
    assert len(hot) >= 5                        # three quarters of the rows
    assert all(a[1] <= b[0] for a, b in zip(hot, hot[1:]))      # and each part is a span of time
    first = laid.filter(F.spark_partition_id() == 0).collect()
    keys = [(r.user_id, r.t) for r in first]
    assert keys == sorted(keys)


def test_user_filter_skips_files(spark, tmpdir_path):
    """A day of 16 files, one user with a third of the rows: by the files'
    statistics, a filter on any other user opens at most two of them."""
    rows = _hot_rows(spark, 30_000, 60_000)
    table = os.path.join(tmpdir_path, "t")
    warehouse.load_partition(rows, table, "2024-01-09", cluster_by=["user_id", "t"], files=16)
    files = _ranges(table, "user_id")
    assert len(files) == 16
    for user in ["u0", "u1", "u250", "u499", "u77"]:
        assert 1 <= sum(lo <= user <= hi for lo, hi, _ in files) <= 2
    assert 4 <= sum(lo <= "hot" <= hi for lo, hi, _ in files) <= 7
    meta = pq.ParquetFile(glob.glob(f"{table}/load=*/day=*/*.parquet")[0]).metadata
    assert meta.num_rows > 0
    read = warehouse.read_table(spark, table)
    assert read.where("user_id = 'u250'").count() == rows.where("user_id = 'u250'").count()


def test_lake_writer_spreads_a_hot_prefix(spark, tmpdir_path):
    rows = _hot_rows(spark, 30_000, 100)
    lines = rows.select(F.lit("2024-01-01").cast("date").alias("day"),
                        F.when(F.col("user_id") == "hot", F.lit("hot-ds"))
                        .otherwise(F.lit("cold-ds")).alias("dataset"),
                        F.to_json(F.struct("user_id", "t")).alias("value"))
    # fixed shards: at most that many files, written by several tasks
    root = os.path.join(tmpdir_path, "lake")
    lake.write_sharded_jsonl(lines, root, shards=6)
    files = glob.glob(f"{root}/load=*/day=2024-01-01/dataset=hot-ds/bucket=*/part-*")
    assert 2 <= len(files) <= 6
    assert lake.scan_jsonl(spark, root).count() == 30_100
    # rebalanced (default): AQE splits the hot prefix by size, keeps the cold one whole
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    try:
        root2 = os.path.join(tmpdir_path, "lake2")
        lake.write_sharded_jsonl(lines, root2)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    hot2 = glob.glob(f"{root2}/load=*/day=2024-01-01/dataset=hot-ds/bucket=*/part-*")
    cold2 = glob.glob(f"{root2}/load=*/day=2024-01-01/dataset=cold-ds/bucket=*")
    assert len(hot2) >= 4 and 1 <= len(cold2) <= lake.BUCKETS
    assert lake.scan_jsonl(spark, root2).count() == 30_100
