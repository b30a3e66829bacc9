"""Removal of passages that recur, by repeated-phrase automata.

A window is ``WINDOW`` consecutive words.  Equal windows have the same smallest
8-gram, so:

1. Every document reports the 8-grams that are smallest in some window; those
   reported at least twice are the only ones around which a window can recur.
2. Documents that have such grams give their candidate segments: runs of
   windows of one smallest gram.  Grams that are very frequent (a common line in
   many different documents) are put last in the order, so that fewer segments
   share a gram.
3. Equal segments become one row with a count, and are dealt into shards by the
   gram.  A gram whose segments are more than a shard (windows that reach out
   over the edges of a very common passage, different in every document) is
   dealt over several parts, and the windows of its parts are counted together
   by their hash.  In a shard the windows are counted, the recurring runs of
   windows, by the counts of all parts, are the confirmed passages, and an
   Aho-Corasick automaton of all passages of the shard, one sign a word, runs
   over the segments and finds each occurrence.
4. The occurrences go back to all documents that hold the segment, and the
   words they cover are removed.

Texts move once, for the join with what was found in them (both joins read the
same columns, so they share one exchange), and the segments twice.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daycut.session import checkpointed

from .common import Shared, keyed
from .textkit import blocks, join_words, mix, ranges, rolling, sliding_min, starts_inside, word_hashes, words

WINDOW = 35
GRAM = 8
#: Words of segments that one automaton is built for.
SHARD_WORDS = 150_000
#: At most so many frequent grams are put last; fixes the size of the
#: broadcast (8 bytes each).
HOT_GRAMS = 1 << 16
#: Reports from which on a gram may be frequent.
HOT_LEAST = 200
_U = np.uint64


def _orders(first: np.ndarray, hashes: np.ndarray, window: int, gram: int):
    """Gram hashes, window starts, their rows, and the smallest gram of every
    window start."""
    grams = rolling(hashes, gram)
    low = sliding_min(grams, window - gram + 1)
    at, row = starts_inside(first, window)
    return grams, at, row, low


def _anchors(first: np.ndarray, hashes: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Grams that are smallest in some window: word position and hash."""
    grams, at, _, low = _orders(first, hashes, window, gram)
    if not len(at):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    span = window - gram + 1
    inside = np.zeros(len(low), dtype=np.uint64)            # 0: not a window of one row
    inside[at] = low[at]
    padded = np.concatenate([np.zeros(span - 1, np.uint64), inside, np.zeros(span - 1, np.uint64)])
    reached = ~sliding_min(~padded, span)                   # largest minimum of the windows around a gram
    pos = np.flatnonzero((reached == grams) & (reached > 0))
    return pos, grams[pos]


def _cut(batch: pa.RecordBatch, hot: np.ndarray, window: int, gram: int) -> dict:
    """Segments of a block of documents with their recurring grams."""
    w = words(batch.column("text"))
    hashes = word_hashes(w)
    grams, at, row, low = _orders(w.first, hashes, window, gram)
    marks = batch.column("marks")
    mark_row = np.repeat(np.arange(len(marks)), marks.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
    mark = marks.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
    tag = lambda r, g: mix(g ^ mix(r.astype(np.uint64) + _U(1)))
    live = np.isin(tag(row, low[at]), tag(mark_row, mark)) if len(at) else np.zeros(0, bool)
    at, row = at[live], row[live]
    # frequent grams last: the key of a window is its smallest other gram
    last = np.isin(grams, hot).astype(np.uint64) << _U(63)
    key = sliding_min((grams >> _U(1)) | last, window - gram + 1)[at] if len(at) else np.zeros(0, np.uint64)
    new = np.ones(len(at), dtype=bool)
    new[1:] = (at[1:] != at[:-1] + 1) | (row[1:] != row[:-1]) | (key[1:] != key[:-1])
    begin = np.flatnonzero(new)
    end = np.append(begin[1:], len(at)) - 1 if len(at) else begin
    lo, hi = at[begin], at[end] + window
    which, _ = ranges(lo, hi)
    first = np.concatenate([[0], np.cumsum(hi - lo)]).astype(np.int64)
    return {"key": pa.array(key[begin].view(np.int64)), "row": row[begin], "start": lo - w.first[row[begin]],
            "words": join_words(w, which, first)}


def _counts(batch: pa.RecordBatch, window: int) -> pa.RecordBatch:
    """Windows of a block of segments: ``key``, ``part``, ``hash`` and the
    number of times that it occurs in the documents."""
    w = words(batch.column("words"))
    at, row = starts_inside(w.first, window)
    whole = rolling(word_hashes(w), window)[at]
    key, part = (batch.column(c).to_numpy()[row] for c in ("key", "part"))
    order = np.lexsort((whole, part, key))
    key, part, whole = key[order], part[order], whole[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = (key[1:] != key[:-1]) | (part[1:] != part[:-1]) | (whole[1:] != whole[:-1])
    begin = np.flatnonzero(new)
    n = np.diff(np.append(begin, len(order))).astype(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(key[begin]), pa.array(part[begin]), pa.array(whole[begin].view(np.int64)),
                                       pa.array(n)], ["key", "part", "hash", "n"])


def locate(table: pa.Table, window: int) -> Iterator[tuple[int, int, int]]:
    """Confirms the passages of a shard and finds them: segment row, first
    word, end word.  ``table``: ``words`` and ``n`` (documents' occurrences);
    rows without words give in ``hash`` a window that recurs over all parts."""
    known = pc.drop_null(table.column("hash").combine_chunks()).to_numpy(zero_copy_only=False).view(np.uint64)
    w = words(table.column("words").combine_chunks())
    hashes = word_hashes(w)
    at, row = starts_inside(w.first, window)
    if not len(at):
        return
    whole = rolling(hashes, window)[at]
    _, back = np.unique(whole, return_inverse=True)
    weight = np.bincount(back, pc.fill_null(table.column("n"), 0).to_numpy()[row])
    again = (weight[back] >= 2) | np.isin(whole, known)
    # passages: runs of recurring windows
    run_at, run_row = at[again], row[again]
    new = np.ones(len(run_at), dtype=bool)
    new[1:] = (run_at[1:] != run_at[:-1] + 1) | (run_row[1:] != run_row[:-1])
    begin = np.flatnonzero(new)
    if not len(begin):
        return
    end = np.append(begin[1:], len(run_at)) - 1
    # one sign a word: 20 bits of the word's hash as a code point
    code = (_U(0x10000) + (hashes >> _U(44))).astype("<u4")
    automaton = ahocorasick.Automaton()
    for lo, hi in zip(run_at[begin].tolist(), (run_at[end] + window).tolist()):
        automaton.add_word(code[lo:hi].tobytes().decode("utf-32-le"), hi - lo)
    automaton.make_automaton()
    confirmed = np.zeros(len(hashes) + 1, dtype=np.int64)
    confirmed[run_at] = 1
    confirmed = np.concatenate([[0], np.cumsum(confirmed)])
    for no in np.unique(run_row).tolist():
        lo, hi = int(w.first[no]), int(w.first[no + 1])
        cover = np.zeros(hi - lo + 1, dtype=np.int64)
        for stop, size in automaton.iter(code[lo:hi].tobytes().decode("utf-32-le")):
            start = stop + 1 - size
            # the signs are 20 bits of a hash: every window must be a confirmed one
            if confirmed[lo + stop + 2 - window] - confirmed[lo + start] == size - window + 1:
                cover[start] += 1
                cover[stop + 1] -= 1
        covered = np.flatnonzero(np.diff(np.concatenate([[0], np.cumsum(cover) > 0, [0]]).astype(np.int8)))
        for a, b in zip(covered[::2].tolist(), covered[1::2].tolist()):
            yield no, a, b


def _shards(window: int, shard_words: int):
    """Function over partitions sorted by key and part: whole parts are
    gathered up to ``shard_words`` words and get one automaton."""

    def done(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(rows)
        found = np.array(list(locate(table, window)), dtype=np.int64).reshape(-1, 3)
        take = pa.array(found[:, 0])
        return pa.RecordBatch.from_arrays(
            [*[table.column(c).take(take).combine_chunks() for c in ("key", "sid")], pa.array(found[:, 1]),
             pa.array(found[:, 2])], ["key", "sid", "lo", "hi"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size, last = 0, None
        for batch in blocks(batches, "words", 256 << 10):
            key, part = (batch.column(c).to_numpy() for c in ("key", "part"))
            edge = np.flatnonzero((key[1:] != key[:-1]) | (part[1:] != part[:-1])) + 1
            edge = np.concatenate([[0] if last is not None and (key[0], part[0]) != last else [], edge]).astype(np.int64)
            # a shard ends where a part ends
            if size >= shard_words and len(edge):
                held.append(batch.slice(0, int(edge[0])))
                yield done(held)
                batch, held, size = batch.slice(int(edge[0])), [], 0
            if batch.num_rows:
                held.append(batch)
                size += (pc.sum(pc.binary_length(batch.column("words"))).as_py() or 0) // 6
                last = key[-1], part[-1]
        if held:
            yield done(held)

    return run


def dealt(segments: DataFrame, distinct: DataFrame, window: int, shard_words: int) -> DataFrame:
    """The distinct segments with the ``part`` of their key, and rows of
    ``hash`` for what a part cannot see: windows that recur over all parts.

    A key of more than ``shard_words`` words (of six bytes) gets a part for each
    that many; segments go to parts by their hash, and there are at most as many
    such keys as shards of text.  A window moves once for each task and part
    that has it, not once a segment.
    """
    # sizes are those with copies: no second exchange of the words, and too many parts do no harm
    large = (segments.groupBy("key").agg(F.sum(F.octet_length("words")).alias("size")).where(F.col("size") > 6 * shard_words)
             .select("key", F.ceil(F.col("size") / F.lit(6 * shard_words)).alias("parts")))
    part = F.coalesce(F.pmod("sid", "parts"), F.lit(0)).cast("long").alias("part")

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "words", 256 << 10):
            yield _counts(batch, window)

    again = (segments.select("key", "words", F.xxhash64("words").alias("sid")).join(F.broadcast(large), "key")
             .select("key", part, "words").mapInArrow(count, "key long, part long, hash long, n long")
             .groupBy("key", "hash").agg(F.sum("n").alias("n"), F.collect_set("part").alias("parts"))
             .where((F.col("n") > 1) & (F.size("parts") > 1)).select("key", F.explode("parts").alias("part"), "hash"))
    return (distinct.join(F.broadcast(large), "key", "left")
            .select("key", part, "words", "n", "sid", F.lit(None).cast("long").alias("hash"))
            .unionByName(again, allowMissingColumns=True))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                   gram: int = GRAM, shard_words: int = SHARD_WORDS, hot_least: int = HOT_LEAST,
                   hot_grams: int = HOT_GRAMS) -> DataFrame:
    """Texts without the words of recurring windows.

    A word goes if a window that covers it starts, with the same words, also
    at another place of this or any other document; windows are judged on the
    input.  Words are compared as they are.  Returns a row per document:
    ``id``, ``n_words``, ``n_removed``, ``kept`` (the kept words joined by one
    space).  Null, empty and short texts lose nothing.  Repeated rows count as
    documents of their own, so long ones lose all their words.  An empty table
    gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    rows = keyed(docs, id_col, text_col)
    texts = rows.select("k2", "text")

    def report(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "text"):
            w = words(batch.column("text"))
            pos, hashes = _anchors(w.first, word_hashes(w), window, gram)
            row = np.searchsorted(w.first, pos, side="right") - 1
            yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), batch.column("k2").take(pa.array(row))],
                                             ["gram", "k2"])

    reported = texts.mapInArrow(report, "gram long, k2 long")
    again = checkpointed(reported.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    least = max(hot_least, (again.agg(F.sum("n")).first()[0] or 0) // hot_grams)
    # fewer than `hot_grams` grams can be reported so often
    hot = [r["gram"] for r in again.where(F.col("n") > least).select("gram").collect()]
    frequent = Shared(spark, np.sort(np.array(hot, dtype=np.int64).view(np.uint64)))
    marks = (reported.join(again.select("gram"), "gram", "left_semi").groupBy("k2")
             .agg(F.collect_set("gram").alias("marks")))

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "text"):
            got = _cut(batch, frequent.value, window, gram)
            take = pa.array(got["row"])
            yield pa.RecordBatch.from_arrays(
                [got["key"], got["words"], batch.column("k1").take(take), batch.column("k2").take(take),
                 pa.array(got["start"].astype(np.int64))], ["key", "words", "k1", "k2", "start"])

    segments = (rows.join(marks, "k2").select("id", "k1", "k2", "text", "marks")
                .mapInArrow(cut, "key long, words string, k1 long, k2 long, start long"))
    distinct = segments.groupBy("key", "words").agg(F.count(F.lit(1)).alias("n")).withColumn("sid", F.xxhash64("words"))
    found = (dealt(segments, distinct, window, shard_words).repartition("key", "part").sortWithinPartitions("key", "part")
             .mapInArrow(_shards(window, shard_words), "key long, sid long, lo long, hi long"))
    places = segments.select("key", F.xxhash64("words").alias("sid"), "k1", "k2", "start").join(found, ["key", "sid"])
    cuts = places.select("k2", F.struct("k1", (F.col("start") + F.col("lo")).alias("lo"),
                                        (F.col("start") + F.col("hi")).alias("hi")).alias("cut"))
    cuts = cuts.groupBy("k2").agg(F.collect_set("cut").alias("cuts"))

    def strip(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "text"):
            w = words(batch.column("text"))
            n = np.diff(w.first)
            cuts = batch.column("cuts")
            row = np.repeat(np.arange(len(cuts)), cuts.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
            part = cuts.flatten()
            k1, lo, hi = (part.field(i).to_numpy(zero_copy_only=False) for i in range(3))
            mine = k1 == batch.column("k1").to_numpy()[row]
            gone, _ = ranges(w.first[row[mine]] + lo[mine], w.first[row[mine]] + hi[mine])
            keep = np.ones(len(w.start), dtype=bool)
            keep[gone] = False
            at = np.flatnonzero(keep)
            first = np.searchsorted(at, w.first)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(n.astype(np.int64)), pa.array((n - np.diff(first)).astype(np.int64)),
                 join_words(w, at, first)], ["id", "n_words", "n_removed", "kept"])

    kind = rows.schema["id"].dataType.simpleString()
    return (rows.join(cuts, "k2", "left").select("id", "k1", "text", "cuts")
            .mapInArrow(strip, f"id {kind}, n_words long, n_removed long, kept string"))
