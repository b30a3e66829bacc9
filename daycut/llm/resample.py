"""Importance resampling towards a target distribution of hashed n-grams.

Each text counts its runs of words in hashed buckets.  The buckets' totals over
all documents and over the target texts give every bucket a gain (an integer,
the scaled logarithm of the ratio of its two shares), held in one array.  A
document weighs the sum of its features' gains; a Gumbel draw from its id is
added, so that the highest scores are a sample without replacement.

The cutoff is found without sorting all scores: a mergeable quantile sketch
brackets it, exact counts of what lies above and inside the bracket prove it or
widen it, and only the bracket is sorted.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from daycut.session import scratch_path

from .common import Shared
from .textkit import Words, blocks, starts_inside, words

#: Words are runs of ASCII letters and digits and of all bytes beyond ASCII.
_BREAK = np.ones(256, dtype=bool)
_BREAK[128:] = False
for _low, _high in ((ord("0"), ord("9")), (ord("A"), ord("Z")), (ord("a"), ord("z"))):
    _BREAK[_low:_high + 1] = False
#: Words of more bytes are hashed one by one.
_LONG = 48

_CRC = np.arange(256, dtype=np.uint32)
for _ in range(8):
    _CRC = np.where(_CRC & 1, (_CRC >> 1) ^ np.uint32(0xEDB88320), _CRC >> 1).astype(np.uint32)


def _feed(state: np.ndarray, w: Words, at: np.ndarray) -> np.ndarray:
    """CRC states after the bytes of the words ``at``."""
    state, size = state.copy(), (w.end - w.start)[at]
    for i in np.flatnonzero(size > _LONG):
        word = w.data[w.start[at[i]]:w.end[at[i]]].tobytes()
        state[i] = zlib.crc32(word, int(state[i]) ^ 0xFFFFFFFF) ^ 0xFFFFFFFF
    order = np.argsort(-size, kind="stable")
    order = order[np.searchsorted(-size[order], -_LONG):]
    run, place, size = state[order], w.start[at[order]], size[order]
    for j in range(int(size[0]) if len(size) else 0):
        n = int(np.searchsorted(-size, -j))                 # words longer than j bytes
        run[:n] = _CRC[(run[:n] ^ w.data[place[:n] + j]) & 255] ^ (run[:n] >> 8)
    state[order] = run
    return state


def feature_buckets(w: Words, n: int, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For runs of 1 to ``n`` words: bucket and row of each run."""
    state = np.zeros(0, np.uint32)
    for g in range(1, n + 1):
        begin, row = starts_inside(w.first, g)
        if g == 1:
            before = np.full(len(begin), 0xFFFFFFFF, dtype=np.uint32)
        else:                                               # runs of g - 1 words that one more word follows
            before = state[begin]
            before = _CRC[(before ^ np.uint32(32)) & 255] ^ (before >> 8)
        fed = _feed(before, w, begin + g - 1)
        state = np.zeros(len(w.start), np.uint32)
        state[begin] = fed
        yield (fed ^ np.uint32(0xFFFFFFFF)).astype(np.int64) % buckets, row


def _count(batches: Iterable[pa.RecordBatch], n: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """Features per bucket of one partition."""
    total = np.zeros(buckets, dtype=np.int64)
    for block in blocks(batches, "text"):
        for bucket, _ in feature_buckets(words(block.column("text"), lower=True, gap=_BREAK), n, buckets):
            total += np.bincount(bucket, minlength=buckets)
    held = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(held, pa.int64()), pa.array(total[held], pa.int64())], ["bucket", "n"])


def _weigh(batches: Iterable[pa.RecordBatch], n: int, gains: Shared) -> Iterator[pa.RecordBatch]:
    gain = gains.value
    for block in blocks(batches, "text"):
        w = words(block.column("text"), lower=True, gap=_BREAK)
        weight, count = np.zeros(block.num_rows, np.int64), np.zeros(block.num_rows, np.int64)
        for bucket, row in feature_buckets(w, n, len(gain)):
            np.add.at(weight, row, gain[bucket])
            count += np.bincount(row, minlength=block.num_rows)
        yield pa.RecordBatch.from_arrays(
            [block.column("id"), pa.array(np.diff(w.first), pa.int64()), pa.array(count), pa.array(weight)],
            ["id", "n_words", "n_features", "weight"])


def bucket_counts(docs: DataFrame, text_col: str = "text", n: int = 1, buckets: int = 10_000) -> np.ndarray:
    """Features per bucket over all texts; ``buckets`` bounds what is collected."""
    found = docs.select(F.col(text_col).alias("text")).mapInArrow(partial(_count, n=n, buckets=buckets), "bucket long, n long")
    out = np.zeros(buckets, dtype=np.int64)
    for row in found.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row.bucket] = row.n
    return out


def bucket_gains(source: np.ndarray, target: np.ndarray, scale: int = 1000) -> np.ndarray:
    """Scaled logarithm of target share over source share per bucket, each
    count raised by one, rounded down."""
    s_all, t_all, k = float(source.sum()), float(target.sum()), float(len(source))
    return np.array([math.floor(scale * math.log((t + 1.0) * (s_all + k) / ((s + 1.0) * (t_all + k))))
                     for s, t in zip(source.tolist(), target.tolist())], dtype=np.int64)


def gumbel(id_col: Column, seed: int, scale: int = 1000) -> Column:
    """A Gumbel draw that follows from the id alone, scaled and rounded down."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-float(scale) * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def cutoff(rows: DataFrame, take: int, total: int, accuracy: int = 10_000,
           ranked: Callable[[DataFrame], DataFrame] | None = None) -> Row | None:
    """The row of rank ``take`` among ``total`` rows (``score``, ``id``,
    ``n_features``): by higher score, then smaller id (nulls last).

    A quantile sketch of the scores gives a bracket around the rank.  Counts of
    the rows above it and in it are exact; where the rank lies outside, the
    bracket is widened (in the end to all rows) and counted again.  Only the
    rows of the bracket are sorted.
    """
    if take < 1:
        return None
    slack = 2.0 / accuracy
    while True:
        share = 1 - take / total
        edges = [max(share - slack, 0.0), min(share + slack, 1.0)]
        low, high = rows.agg(F.percentile_approx("score", edges, accuracy).alias("e")).first().e
        low = low if edges[0] > 0 else None
        high = high if edges[1] < 1 else None
        over = F.lit(False) if high is None else F.col("score") > high
        under = F.lit(False) if low is None else F.col("score") < low
        above, inside = rows.agg(F.count_if(over), F.count_if(~over & ~under)).first()
        if above < take <= above + inside:
            return (ranked or rank_rows)(rows.where(~over & ~under)).where(F.col("rank") == take - above).first()
        slack *= 8


_ORDER = (F.desc, "score"), (F.asc_nulls_last, "id"), (F.asc, "n_features")


def _order() -> list[Column]:
    return [way(name) for way, name in _ORDER]


def rank_rows(rows: DataFrame) -> DataFrame:
    """``rows`` and their ``rank`` (from 1) by score, id, feature count.

    The rows are dealt by ranges of that order and numbered inside each range;
    the ranges' sizes, one row per partition, give each its offset.
    """
    spark = rows.sparkSession
    path, parts = scratch_path(spark, "ranked"), int(spark.conf.get("spark.sql.shuffle.partitions"))
    (rows.repartitionByRange(parts, *_order()).sortWithinPartitions(*_order())
     .withColumns({"part": F.spark_partition_id(), "at": F.monotonically_increasing_id()})
     .withColumn("at", F.col("at").bitwiseAND((1 << 33) - 1)).write.parquet(path))
    placed = spark.read.parquet(path)
    sizes = {r["part"]: r["count"] for r in placed.groupBy("part").count().collect()}
    before, offsets = 0, []
    for part in sorted(sizes):
        offsets.append((part, before))
        before += sizes[part]
    offsets = spark.createDataFrame(offsets, "part int, before long")
    return placed.join(F.broadcast(offsets), "part").withColumn("rank", F.col("before") + F.col("at") + 1).drop("part", "at", "before")


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text: str = "text",
             n: int = 1, buckets: int = 10_000, seed: int = 2024, min_words: int = 20, percent: int = 10) -> DataFrame:
    """Draw ``percent`` of the documents of at least ``min_words`` words,
    towards the distribution of the target texts.

    Returns every document's ``id``, ``n_words``, ``n_features``, ``weight``,
    ``score`` and ``rank`` (null if not drawn); ranks go by score, then smaller
    id, then feature count.  A null or empty text has no words and weighs 0.
    A null id draws like an empty one and comes last in ties; rows of one id
    draw alike.  With an empty target all its counts are 0.  An empty table
    gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    gains = Shared(spark, bucket_gains(bucket_counts(docs, text_col, n, buckets),
                                       bucket_counts(target, target_text, n, buckets)))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = f"id {texts.schema['id'].dataType.simpleString()}, n_words long, n_features long, weight long"
    path = scratch_path(spark, "weights")
    (texts.mapInArrow(partial(_weigh, n=n, gains=gains), schema)
     .withColumn("score", F.col("weight") + gumbel(F.col("id"), seed)).write.parquet(path))
    scored = spark.read.parquet(path)
    fit = scored.where(F.col("n_words") >= min_words)
    total = fit.count()
    last = cutoff(fit, percent * total // 100, total)
    if last is None:
        return scored.withColumn("rank", F.lit(None).cast("long"))
    # not behind the cutoff row in the order
    key = F.col("id").isNull(), F.col("id"), F.col("n_features")
    here = F.lit(last.id is None), F.lit(last.id).cast(scored.schema["id"].dataType), F.lit(last.n_features)
    same_id = key[1].eqNullSafe(here[1])
    ahead = (F.col("score") > last.score) | ((F.col("score") == last.score) & (
        (key[0] < here[0]) | F.coalesce(key[1] < here[1], F.lit(False)) | (same_id & (key[2] <= here[2]))))
    drawn = (F.col("n_words") >= min_words) & ahead
    # repeated rows can tie with the cutoff row in all columns: the ranks beyond it go
    ranks = rank_rows(scored.where(drawn))
    return scored.where(~drawn).withColumn("rank", F.lit(None).cast("long")).unionByName(
        ranks.withColumn("rank", F.when(F.col("rank") <= percent * total // 100, F.col("rank"))))
