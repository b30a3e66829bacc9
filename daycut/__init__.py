"""daycut — activity and time-tracking analytics on Spark.

Facts are kept as UTC epoch integers in pieces of at most 30 minutes, so that
reports can re-cut them into the local days of any time zone.  Everything is
expressed with DataFrames and built-in Spark functions:

* ``daycut.sources``   — landing envelopes, JSONL lake scans, schemas, calendar
* ``daycut.operators`` — flatten/project, interval clip/split, zone filters,
                         daily aggregation blocks, rejects
* ``daycut.sinks``     — sharded JSONL lake writer, day-partition warehouse load
* ``daycut.plans``     — the daily reports and the load jobs
"""

from daycut.session import build_session, scratch_path

__all__ = ["build_session", "scratch_path"]
