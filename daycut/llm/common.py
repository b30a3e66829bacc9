"""Spark helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daycut.session import checkpointed

WORD = r"[^\x20\x09-\x0D]+"


def keyed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Columns ``id``, ``text`` and the row key ``k1``, ``k2`` (never null).

    Only identical (id, text) rows share a key, so a join on the key treats
    repeated rows alike.  All other columns go, so none can clash.
    """
    df = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return df.withColumns({"k1": F.xxhash64("id"), "k2": F.xxhash64("id", "text", F.col("text").isNull())})


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores before it as make it none of
    the table's columns (Spark's names do not tell case apart)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def _stars(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges of one partition as stars: each node once, with the smallest node
    it is connected to here."""
    top: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := top.get(x, x)) != x:
            top[x] = x = top.get(up, up)
        return x

    for batch in batches:
        for u, v in zip(batch.column("u").to_pylist(), batch.column("v").to_pylist()):
            u, v = find(u), find(v)
            if u != v:
                top[max(u, v)] = min(u, v)
    nodes = list(top)
    for lo in range(0, len(nodes), 1 << 16):
        part = nodes[lo:lo + (1 << 16)]
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array([find(x) for x in part], pa.int64())],
                                         ["u", "v"])


def components(edges: DataFrame, checkpoint=checkpointed) -> DataFrame:
    """Connected components of an undirected graph.

    ``edges``: ``u``, ``v`` (long, not null).  Returns ``node``, ``comp`` with
    the smallest node of each component.  A round deals the edges by their
    larger node, hangs each node on the smallest one that its partition knows,
    and then on what that one hangs on (a join); it ends when all hang on
    nodes that hang on nothing.  A node of very many neighbours is their
    smallest after the first pass, made before anything moves, and edges are
    never dealt by the smaller node but in the join, which can be split.
    """
    nodes = edges.select(F.col("u").alias("node")).union(edges.select("v")).distinct()
    now = edges.where("u <> v").select("u", "v").mapInArrow(_stars, "u long, v long")
    while True:
        stars = checkpoint(now.repartition("u").mapInArrow(_stars, "u long, v long"))
        up = stars.select(F.col("u").alias("v"), F.col("v").alias("top"))
        now = stars.join(up, "v", "left").select("u", F.coalesce("top", "v").alias("v"), F.col("top").isNotNull().alias("moved"))
        if now.where("moved").isEmpty():
            break
        now = now.select("u", "v")
    up = stars.withColumnsRenamed({"u": "node", "v": "top"})
    return nodes.join(up, "node", "left").select("node", F.coalesce("top", "node").alias("comp"))


class Shared:
    """A broadcast value whose classes need not be importable on executors."""

    def __init__(self, spark, value) -> None:
        self._sent, self._got = spark.sparkContext.broadcast(cloudpickle.dumps(value)), None

    def __getstate__(self):
        return self._sent

    def __setstate__(self, sent) -> None:
        self._sent, self._got = sent, None

    @property
    def value(self):
        if self._got is None:
            self._got = (cloudpickle.loads(self._sent.value),)
        return self._got[0]


def sample(rows: DataFrame, by: str, size: int) -> DataFrame:
    """At most ``size`` rows of different ``by`` (a hash), the smallest ones.

    A threshold on the hash keeps about twice as many first, and rows of one
    hash (copies) become one before they move, so that the sort behind it sees
    a number of rows that does not grow with the table.
    """
    n, name, by = rows.count(), by, F.col(by)
    if n > 2 * size:
        cells = 1 << 40
        rows = rows.where(F.pmod(by, F.lit(cells)) < int(cells * 2 * size / n))
    return rows.dropDuplicates([name]).orderBy(F.pmod(by, F.lit(1 << 40)), by).limit(size)


def sample_each(rows: DataFrame, per: str, by: str, size: int) -> DataFrame:
    """Columns ``per`` and ``by`` (a hash) of at most ``size`` different rows,
    the smallest hashes of each value of ``per`` (few values, not null).

    The values share ``size`` evenly; what a rare one leaves goes to the others.
    Copies are not counted: the threshold that bounds what moves comes from the
    number of different hashes of each value.
    """
    rows, cells = rows.select(per, by), 1 << 40
    place = F.pmod(F.col(by), F.lit(cells))
    known = sorted(((r["n"], r[per]) for r in rows.groupBy(per).agg(F.approx_count_distinct(by).alias("n")).collect()))
    if not known:
        return rows
    share, limit, left = {}, {}, size
    for no, (n, value) in enumerate(known):
        # with room for what the count of different hashes may be off
        share[value] = min(left // (len(known) - no), n + n // 5 + 16)
        limit[value] = cells if n <= 2 * share[value] + 64 else int(cells * (2 * share[value] + 64) / n)
        left -= share[value]

    def of(numbers: dict[str, int]) -> Column:
        return F.create_map(*[F.lit(x) for kv in numbers.items() for x in kv])[F.col(per)]

    order = Window.partitionBy(per).orderBy(place, by)
    return (rows.where(place < of(limit)).distinct().withColumn("_no", F.row_number().over(order))
            .where(F.col("_no") <= of(share)).select(per, by))
