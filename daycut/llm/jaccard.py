"""Exact Jaccard join of documents on word n-grams, by prefix trees.

1. Every document becomes the set of its n-gram hashes.  Equal sets are one
   class from here on.  Sorted by hash, two sets that overlap in ``o`` or more
   share ``l`` members among the first ``n - o + l`` of each; only these are
   reported, and a class of which fewer than ``l`` reported n-grams occur in
   any other report has no partner and is done.
2. Of the rest, the rarest reported n-grams (as many as exclude a miss) connect
   classes to candidate blocks; every link lies inside a block.
3. Blocks beyond a size are cut once more, by the rarest n-grams of the whole
   sets; what is still larger is joined part against part.
4. A block is joined in one task: its sets, in one global order from rare to
   frequent, are stored in a trie.  A probe walks to the leaves that share a
   prefix n-gram, counts the overlap once along shared paths, and leaves a
   subtree when what remains can't reach the bound.  Sets that are already
   connected are not compared.

The result is the component of each document; links among copies are not
listed.  Sets are compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daycut.session import checkpointed

from .common import components, free_names, keyed
from .textkit import blocks, mix, rolling, starts_inside, word_hashes, words

NGRAM = 5
PERCENT = 80
#: Share of a set's n-grams that its first ones must share with a partner's.
SHARE = 0.06
#: n-grams of the sets of one trie.
BLOCK_GRAMS = 1_000_000
_U = np.uint64


def _least(n, percent: int):
    """Smallest overlap a set of ``n`` may have with a partner."""
    return -(-n * percent // 100)


def _common(n: int, share: float) -> int:
    return max(1, int(n * share))


def ngram_sets(column: pa.Array, k: int = NGRAM) -> list[np.ndarray]:
    """Sorted n-gram hashes of each text, A-Z lowered.

    Fewer words than ``k`` are one n-gram; no words, no n-gram.
    """
    w = words(column, lower=True)
    hashes = word_hashes(w)
    grams = rolling(hashes, k)
    out = []
    for lo, hi in zip(w.first[:-1].tolist(), w.first[1:].tolist()):
        if hi - lo >= k:
            found = np.sort(grams[lo:hi - k + 1])
            out.append(found[np.concatenate([[True], found[1:] != found[:-1]])])
        else:
            out.append(rolling(hashes[lo:hi], hi - lo) if hi > lo else grams[:0])
    return out


def signature(found: np.ndarray) -> int:
    """One number for a set; equal sets have equal ones."""
    return int(mix(np.array([mix(found).sum() + _U(len(found))], dtype=np.uint64)).view(np.int64)[0])


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    off = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    flat = np.concatenate([*arrays, np.zeros(0, np.uint64)]).view(np.int64)
    return pa.ListArray.from_arrays(pa.array(off), pa.array(flat))


def trie_links(sets: list[np.ndarray], percent: int = PERCENT) -> np.ndarray:
    """Components of one block: for each set the number of the first set (in
    the given order) that it is connected with."""
    m = len(sets)
    size = np.array([len(s) for s in sets], dtype=np.int64)
    label = np.arange(m)
    if m < 2:
        return label
    flat = np.concatenate(sets)
    _, token, count = np.unique(flat, return_inverse=True, return_counts=True)
    rank = np.empty(len(count), dtype=np.int64)
    rank[np.argsort(count, kind="stable")] = np.arange(len(count))          # rare to frequent
    df = np.empty_like(count)
    df[rank] = count
    off = np.concatenate([[0], np.cumsum(size)])
    rows = [np.sort(rank[token[a:b]]) for a, b in zip(off[:-1], off[1:])]
    prefix = size - _least(size, percent) + 1
    # leaves of the trie in path order, without sets that share no prefix n-gram
    live = [i for i in range(m) if (df[rows[i][:prefix[i]]] > 1).any()]
    if len(live) < 2:
        return label
    live.sort(key=lambda i: rows[i].astype(">i4").tobytes())
    paths = [rows[i] for i in live]
    n = size[live]
    lcp = np.zeros(len(live), dtype=np.int64)                                # with the leaf before
    for j in range(1, len(live)):
        a, b = paths[j - 1], paths[j]
        k = min(len(a), len(b))
        differ = np.flatnonzero(a[:k] != b[:k])
        lcp[j] = differ[0] if len(differ) else k
    lead = [p[:prefix[i]] for p, i in zip(paths, live)]
    lead_token = np.concatenate(lead)
    lead_leaf = np.repeat(np.arange(len(live)), [len(x) for x in lead])
    by = np.argsort(lead_token, kind="stable")
    lead_token, lead_leaf = lead_token[by], lead_leaf[by]
    part = np.arange(len(live))                                              # component of a leaf
    inside = np.zeros(len(count), dtype=bool)
    # sets whose n-grams are the most shared go first: they connect most
    centre = np.array([df[p].mean() for p in paths])
    for x in np.argsort(-centre, kind="stable"):
        probe = paths[x]
        lo = np.searchsorted(lead_token, lead[x], side="left")
        hi = np.searchsorted(lead_token, lead[x], side="right")
        reach = np.unique(np.concatenate([lead_leaf[a:b] for a, b in zip(lo, hi) if b - a > 1] or [lead_leaf[:0]]))
        need = -(-percent * (n[x] + n[reach]) // (100 + percent))
        reach = reach[(part[reach] != part[x]) & (need <= np.minimum(n[x], n[reach]))]
        if not len(reach):
            continue
        inside[probe] = True
        have = np.zeros(int(n[reach].max()) + 1, dtype=np.int64)             # overlap along the path
        known, at, dead, most = 0, -1, -1, 0
        for y in reach.tolist():
            if part[y] == part[x]:
                continue
            if at >= 0:
                shared = int(lcp[at + 1:y + 1].min())
                known = min(known, shared)
                if dead >= 0 and shared > dead and n[y] <= most:             # a pruned subtree
                    continue
            path, bound = paths[y], -(-percent * (n[x] + n[y]) // (100 + percent))
            at, dead = y, -1
            # the part beyond the shared path; misses can't exceed n - bound
            have[known + 1:len(path) + 1] = have[known] + np.cumsum(inside[path[known:]])
            missed = np.arange(len(path) + 1) - have[:len(path) + 1]
            fail = int(np.searchsorted(missed, n[y] - bound + 1))
            known = len(path)
            if fail <= len(path):
                dead, most = fail - 1, int(n[y])                             # no leaf of this length below can do
            elif have[len(path)] >= bound:
                part[part == part[y]] = part[x]
        inside[probe] = False
    first: dict[int, int] = {}
    for j in np.argsort(live):
        first.setdefault(int(part[j]), live[j])
    for j, i in enumerate(live):
        label[i] = first[int(part[j])]
    return label


def _join_tries(percent: int):
    """Function over partitions sorted by ``task``: links of each block."""

    def links(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held).combine_chunks()
        sig, grams = table.column("sig").to_numpy(), table.column("grams").combine_chunks()
        _, pick = np.unique(sig, return_index=True)
        off, flat = grams.offsets.to_numpy(), grams.values.to_numpy().view(np.uint64)
        label = trie_links([flat[off[i]:off[i + 1]] for i in pick], percent)
        mine = sig[pick]
        other = label != np.arange(len(label))
        return pa.RecordBatch.from_arrays([pa.array(mine[other]), pa.array(mine[label[other]])], ["u", "v"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            task = batch.column("task").to_numpy()
            edges = np.concatenate([[0], np.flatnonzero(task[1:] != task[:-1]) + 1, [len(task)]]).astype(int)
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
                if b > a:
                    if held and task[a] != last:
                        yield links(held)
                        held = []
                    held.append(batch.slice(a, b - a))
                    last = task[a]
        if held:
            yield links(held)

    return run


def _blocks_of(buckets: DataFrame) -> DataFrame:
    """Components of classes (``sig``) that share a bucket (``gram``)."""
    centre = buckets.groupBy("gram").agg(F.min("sig").alias("v"))
    return components(buckets.join(centre, "gram").select(F.col("sig").alias("u"), "v").distinct()).select(
        F.col("node").alias("sig"), F.col("comp").alias("block"))


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ngram: int = NGRAM,
                       percent: int = PERCENT, share: float = SHARE, block_grams: int = BLOCK_GRAMS) -> DataFrame:
    """Component of each document under "Jaccard similarity of the n-gram sets
    of at least ``percent``".

    Returns a row per document: ``id``, ``k1``, ``k2`` (row key), ``n`` (set
    size), ``component`` (smallest id reachable, its own included).  Null and
    empty texts have an empty set and stay alone.  Repeated rows and equal
    texts are linked.  Null ids take part but are never the smallest id, unless
    all of a component are null.  An empty table gives no rows; other columns
    are ignored.
    """
    rows = keyed(docs, id_col, text_col)
    kind = rows.schema["id"].dataType.simpleString()

    def report(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in blocks(batches, "text"):
            sets = ngram_sets(batch.column("text"), ngram)
            sig = [signature(s) for s in sets]
            head = []
            for s, k in zip(sets, sig):
                new = k not in seen and len(s) > 0                    # copies in this task report once
                seen.add(k)
                head.append(s[:len(s) - _least(len(s), percent) + _common(len(s), share)] if new else s[:0])
            if len(seen) > 1_000_000:
                seen.clear()
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("k1"), batch.column("k2"), pa.array(sig, pa.int64()),
                 pa.array([len(s) for s in sets], pa.int64()), _lists(head)], ["id", "k1", "k2", "sig", "n", "head"])

    sets = checkpointed(rows.mapInArrow(
        report, f"id {kind}, k1 long, k2 long, sig long, n long, head array<long>"))
    members = sets.drop("head").where("n > 0")
    classes = checkpointed(members.groupBy("sig").agg(F.min("id").alias("rep"), F.min("k2").alias("k2"),
                                                      F.max("n").alias("n")))
    heads = sets.where(F.size("head") > 0).select("sig", "n", F.explode("head").alias("gram"))
    often = heads.groupBy("gram").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    least = F.ceil(F.col("n") * percent / 100)
    need = F.greatest(F.floor(least * share), F.lit(1))
    reached = (heads.join(often, "gram").groupBy("sig")
               .agg(F.collect_set(F.struct("df", "gram")).alias("hits"), F.max("n").alias("n"))
               .where(F.size("hits") >= need))
    buckets = checkpointed(reached.select("sig", F.explode(F.slice(
        F.array_sort("hits"), F.lit(1), (F.size("hits") - need + 1).cast("int"))["gram"]).alias("gram")))
    placed = _blocks_of(buckets).join(classes, "sig")
    sizes = placed.groupBy("block").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("many")).where("many > 1")
    placed = checkpointed(placed.join(sizes, "block").select("sig", "k2", "n", "block", "total"))

    def whole(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()                  # equal rows are one set of a task before anything moves
        for batch in blocks(batches, "text"):
            first = []
            for i, at in enumerate(zip(batch.column("sig").to_pylist(), batch.column("block").to_pylist())):
                if at not in seen:
                    seen.add(at)
                    first.append(i)
            batch = batch.take(pa.array(first, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in ("sig", "n", "block", "total")],
                 _lists(ngram_sets(batch.column("text"), ngram))], ["sig", "n", "block", "total", "grams"])

    whole_sets = (rows.select("k2", "text").join(placed, "k2").select("text", "sig", "n", "block", "total")
                  .mapInArrow(whole, "sig long, n long, block long, total long, grams array<long>"))
    if placed.where(F.col("total") > block_grams).isEmpty():
        tasks, split = whole_sets.withColumn("task", F.col("block")), False
    else:
        whole_sets = checkpointed(whole_sets)
        tasks, split = _cut_large(whole_sets, percent, block_grams)
    links = checkpointed(tasks.select("task", "sig", "grams").repartition("task").sortWithinPartitions("task")
                         .mapInArrow(_join_tries(percent), "u long, v long"))
    if split:
        links = components(links).select(F.col("node").alias("u"), F.col("comp").alias("v"))
    group = classes.join(links.select(F.col("u").alias("sig"), F.col("v").alias("root")), "sig", "left").select(
        "sig", "rep", F.coalesce("root", "sig").alias("root"))
    lowest = group.groupBy("root").agg(F.min("rep").alias("lowest"))
    named = group.join(lowest, "root").select("sig", "root", "lowest")
    return (members.join(named, "sig").select("id", "k1", "k2", "n", F.col("lowest").alias("component"), "root")
            .union(sets.where("n = 0").select("id", "k1", "k2", "n", F.col("id").alias("component"),
                                              F.lit(None).cast("long").alias("root"))))


def one_of_each(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with one document of each component: the one of
    smallest id (then key).  Documents with an empty set all stay."""
    order = F.struct(F.col("id").isNull().alias("none"), "id", "k1", "k2")
    kept = found.where("n > 0").groupBy("root").agg(F.min(order).alias("best")).select("best.k1", "best.k2")
    # several rows of one key are identical; one of them stays
    many = found.where("n > 0").groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("times"))
    drop = many.join(kept, ["k1", "k2"], "left_anti")
    k1, k2, again = free_names(docs, "_k1", "_k2", "_twice")
    named = [F.col("k1").alias(k1), F.col("k2").alias(k2)]
    twice = many.where("times > 1").join(kept, ["k1", "k2"], "left_semi").select(*named, F.lit(True).alias(again))
    keys = {k1: F.xxhash64(id_col), k2: F.xxhash64(id_col, text_col, F.col(text_col).isNull())}
    left = docs.withColumns(keys).join(drop.select(*named), [k1, k2], "left_anti").join(twice, [k1, k2], "left")
    return (left.where(F.col(again).isNull()).union(left.where(F.col(again)).dropDuplicates([k1, k2]))
            .drop(k1, k2, again))


def _cut_large(sets: DataFrame, percent: int, block_grams: int) -> tuple[DataFrame, bool]:
    """Tasks of all blocks: large ones are cut by their rarest n-grams, and
    those that stay large into pairs of parts.  Whether there are such."""
    small = sets.where(F.col("total") <= block_grams).withColumn("task", F.col("block"))
    large = sets.where(F.col("total") > block_grams)
    grams = large.select("sig", "n", F.explode("grams").alias("gram")).distinct()
    df = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("df"))
    length = (F.col("n") - F.ceil(F.col("n") * percent / 100) + 1).cast("int")
    rare = grams.join(df, "gram").groupBy("sig", "n").agg(
        F.slice(F.array_sort(F.collect_list(F.struct("df", "gram"))), F.lit(1), length).alias("head"))
    buckets = checkpointed(rare.select("sig", F.explode("head").alias("g")).where("g.df > 1")
                           .select("sig", F.col("g.gram").alias("gram")))
    again = _blocks_of(buckets).withColumnRenamed("block", "inner")
    large = large.join(again, "sig")
    sizes = large.dropDuplicates(["sig"]).groupBy("inner").agg(F.sum("n").alias("size"))
    parts = F.when(F.col("size") > block_grams, F.ceil(F.col("size") / (block_grams / 2))).otherwise(1)
    large = checkpointed(large.join(sizes, "inner").withColumn("parts", parts))
    part = F.pmod(F.xxhash64("sig"), F.col("parts"))
    pairs = (large.withColumn("part", part)
             .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
             .withColumn("task", F.when(F.col("parts") == 1, F.col("inner")).otherwise(F.xxhash64(
                 "inner", F.least("part", "other"), F.greatest("part", "other")))))
    return small.select("task", "sig", "grams").union(pairs.select("task", "sig", "grams")), not large.where(
        "parts > 1").isEmpty()
