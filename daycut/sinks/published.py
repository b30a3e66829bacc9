"""Loads that appear at once: data folders named by a published list.

A root (lake or warehouse table) holds one folder per load, ``load=<id>/…``,
written by a job of its own, and below ``_published`` one small list per load
of the slots (day, dataset, bucket) that it replaces.  Readers take for each
slot the folder of the newest list that names it, so

* a load that fails midway leaves no list, and what was there stays readable;
* nothing that may be read is ever overwritten or deleted by a load;
* a slot can be replaced by nothing (it is listed without files).

Lists are small: a slot per day (tables) or per day, dataset and user bucket
(lake); a reader collects those of the days it asks for.
"""

from __future__ import annotations

import datetime as _dt
import json
import time
import uuid
from collections.abc import Iterable
from typing import NamedTuple
from urllib.parse import unquote

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

LISTS = "_published"
LIST_SCHEMA = "load string, day string, dataset string, bucket int, buckets int, files int, columns string"


class Slot(NamedTuple):
    """What one load holds for a day (and dataset and user bucket)."""

    load: str
    day: str
    dataset: str | None = None
    bucket: int | None = None
    buckets: int | None = None          # of its prefix
    files: int = 0
    columns: str | None = None          # schema, as JSON


def new_load() -> str:
    """A load id; ids sort by the time they were made."""
    return f"{time.time_ns() // 1000:017d}-{uuid.uuid4().hex[:8]}"


def load_path(root: str, load: str) -> str:
    return f"{root.rstrip('/')}/load={load}"


def written(spark: SparkSession, root: str, load: str, columns: str, fmt: str) -> dict[tuple, int]:
    """Files per folder below a load, by listing: {(("day", …), …): files}."""
    found: dict[tuple, int] = {}
    top = f"/load={load}/"
    for name in spark.read.schema(columns).format(fmt).load(load_path(root, load)).inputFiles():
        parts = unquote(name[name.index(top) + len(top):]).split("/")[:-1]
        key = tuple(tuple(p.split("=", 1)) for p in parts)
        found[key] = found.get(key, 0) + 1
    return found


def _folder(spark: SparkSession, path: str):
    """Hadoop path and its file system."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def publish(spark: SparkSession, root: str, slots: Iterable[Slot]) -> None:
    """Make the slots current, by one list: a small file that appears whole
    (written under a hidden name, then renamed)."""
    lines = "".join(json.dumps(s._asdict()) + "\n" for s in slots)
    if not lines:
        return
    base, name = f"{root.rstrip('/')}/{LISTS}", f"{new_load()}.json"
    hidden, fs = _folder(spark, f"{base}/_{name}")
    out = fs.create(hidden)
    out.write(lines.encode())
    out.close()
    if not fs.rename(hidden, _folder(spark, f"{base}/{name}")[0]):
        raise OSError(f"could not publish {base}/{name}")


def current(spark: SparkSession, root: str, days: list[str] | None = None, dataset: str | None = None) -> list[Slot] | None:
    """The current slots (of the days, the dataset); None for a root without
    lists."""
    base = f"{root.rstrip('/')}/{LISTS}"
    where, fs = _folder(spark, base)
    if not fs.exists(where):
        return None
    lists = spark.read.schema(LIST_SCHEMA).json(base)
    if days is not None:
        lists = lists.where(F.col("day").isin(*days))
    if dataset is not None:
        lists = lists.where(F.col("dataset") == dataset)
    newest = lists.groupBy("day", "dataset", "bucket").agg(F.max_by(F.struct(lists.columns), "load").alias("s"))
    return [Slot(*r) for r in newest.select("s.*").collect()]


def paths(root: str, slots: Iterable[Slot]) -> list[str]:
    """Folders of the slots that have files; a prefix whose buckets all come
    from one load is one folder."""
    whole: dict[tuple, list[Slot]] = {}
    for s in slots:
        if s.files:
            whole.setdefault((s.load, s.day, s.dataset), []).append(s)
    sizes: dict[tuple, int] = {}
    for s in slots:
        sizes[s.load, s.day, s.dataset] = sizes.get((s.load, s.day, s.dataset), 0) + 1
    out = []
    for (load, day, dataset), some in whole.items():
        folder = f"{load_path(root, load)}/day={day}" + (f"/dataset={dataset}" if dataset is not None else "")
        if some[0].bucket is None or sizes[load, day, dataset] == some[0].buckets:
            out.append(folder)
        else:
            out += [f"{folder}/bucket={s.bucket}" for s in some]
    return sorted(out)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder (through Spark's file system of that path)."""
    where, fs = _folder(spark, path)
    fs.delete(where, True)


def expire(spark: SparkSession, root: str, keep: _dt.timedelta = _dt.timedelta(days=7)) -> list[str]:
    """Delete the load folders below ``root`` that no current slot names and
    that are older than ``keep`` (readers that started before may still use
    them), and join the lists into one.  Returns the loads deleted."""
    where, fs = _folder(spark, root)
    lists, _ = _folder(spark, f"{root.rstrip('/')}/{LISTS}")
    if not fs.exists(lists):
        return []
    names = lambda path: [s.getPath().getName() for s in fs.listStatus(path)]
    old = [n for n in names(lists) if not n.startswith("_")]
    slots = current(spark, root)
    if len(old) > 1:
        publish(spark, root, slots)
        for name in old:
            remove(spark, f"{lists}/{name}")
    live = {s.load for s in slots if s.files}
    before = f"{(time.time_ns() // 1000) - keep // _dt.timedelta(microseconds=1):017d}"
    gone = [n[5:] for n in names(where) if n.startswith("load=") and n[5:] < before and n[5:] not in live]
    for load in gone:
        remove(spark, load_path(root, load))
    return gone
