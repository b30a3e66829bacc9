"""Rows/s of the two load jobs (B1 sessions branch, B2) on landed lake lines.

    python tools/load_throughput.py [/root/testdata/sf0.1]

Lines are derived from ``events`` and landed once (not timed); then each load
(scan → flatten/project → clip/split → clustered day-partition write) runs
four times and the best of the last three is reported.
"""

from __future__ import annotations

import os
import sys
import time

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, HERE)


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    from pyspark.sql import functions as F

    from daycut.functions import timez
    from daycut.plans import catalog_io, jobs, landed
    from daycut.session import build_session, scratch_path
    from daycut.sinks import lake
    spark = build_session("local[8]", shuffle_partitions=8, extra_conf={
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    ev = catalog_io._events(spark, sf_dir)
    root = scratch_path(spark, "throughput-lake")
    lake.write_sharded_jsonl(landed.time_tracking_lines(ev)
                             .withColumn("dataset", F.lit(jobs.DATASETS["time_tracking"])), root)
    ses = catalog_io.delivered_sessions(ev)
    item = F.struct(F.col("id"), F.col("name"),
                    *[F.col(c).cast("string").alias(c) for c in
                      ("startTimeMillis", "endTimeMillis", "modifiedTimeMillis")],
                    F.struct(F.col("application_packageName").alias("packageName"))
                    .alias("application"), F.col("activityType"), F.col("user_id"))
    jobs.land_documents(ses.select("day", "user_id", item.alias("r")).select("day", "r.*"),
                        root, jobs.DATASETS["sessions"])

    def b2():
        good, _ = jobs.time_tracking_rows(
            lake.scan_jsonl(spark, root, dataset=jobs.DATASETS["time_tracking"]))
        jobs.load_all_days(good, scratch_path(spark, "throughput-tt"), jobs.TRACKING_CLUSTER)

    def b1():
        lines = lake.scan_jsonl(spark, root, dataset=jobs.DATASETS["sessions"])
        lo = F.unix_millis(F.col("day").cast("timestamp"))
        good, _ = jobs.session_rows(lines, lo=lo, hi=lo + F.lit(timez.MILLIS_PER_DAY))
        jobs.load_all_days(good, scratch_path(spark, "throughput-ses"), jobs.SESSION_CLUSTER)

    for label, fn, ds in (("B2 time tracking", b2, "time_tracking"),
                          ("B1 sessions", b1, "sessions")):
        n = lake.scan_jsonl(spark, root, dataset=jobs.DATASETS[ds]).count()
        times = []
        for _ in range(4):
            t0 = time.perf_counter()
            fn()
            times.append(time.perf_counter() - t0)
        best = min(times[1:])
        print(f"{label}: {n} lines, {best:.2f} s, {n / best:,.0f} rows/s")


if __name__ == "__main__":
    main(sys.argv)
