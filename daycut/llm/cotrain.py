"""Quality classifier by co-training.

Two views of a document: its content (hashed runs of letters and of other
signs) and its page metadata (columns such as source and language, and layout
statistics: length, shares of signs, capitals and digits, word length, lines,
repetition).  Each view trains a logistic classifier on labelled rows; over
some rounds each gives the other the unlabelled rows it is sure of, as
pseudo-labels.  Both are calibrated on labelled rows kept aside and combined.

Only the labelled rows are sampled, and their bound is a parameter.  A round of
the exchange passes over all other documents and sums up the sure ones, in
tasks, as mean rows of a fixed number of groups, which join the fit with the
weight of their rows; every document is scored.  All of these are passes without
a shuffle of texts, by weights of a fixed size.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daycut.session import checkpointed

from .common import Shared, sample
from .textkit import Words, blocks, text_bytes, word_hashes

#: Hashed features of the content view and of the metadata view.
CONTENT = 1 << 15
META = 1 << 10
#: Bound of the sample of labelled rows, taken by smallest hash of the id.
LABELLED_ROWS = 6000
ROUNDS = 2
#: A pseudo-label is given from this confidence on.
CONFIDENT = 0.97
#: The pseudo-labelled rows of a class are summed up in so many mean rows.
GROUPS = 8
#: Feature values are summed as multiples of this part of one.
_UNIT = 1 << 20

_CLASS = np.full(256, 2, dtype=np.uint8)              # other signs
_CLASS[[9, 10, 11, 12, 13, 32]] = 0
_CLASS[list(range(65, 91)) + list(range(97, 123)) + list(range(128, 256))] = 1
_U = np.uint64


class Sparse(NamedTuple):
    """Rows of sparse features; row r is entries first[r]:first[r + 1]."""

    first: np.ndarray
    index: np.ndarray
    value: np.ndarray

    def times(self, w: np.ndarray) -> np.ndarray:
        row = np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))
        return np.bincount(row, self.value * w[self.index], minlength=len(self.first) - 1)

    def pick(self, rows: np.ndarray) -> "Sparse":
        size = np.diff(self.first)[rows]
        at = np.arange(size.sum()) + np.repeat(self.first[:-1][rows] - (np.cumsum(size) - size), size)
        return Sparse(np.concatenate([[0], np.cumsum(size)]), self.index[at], self.value[at])


def content_view(column: pa.Array) -> tuple[Sparse, dict[str, np.ndarray]]:
    """Content features of a block of texts, and its layout statistics."""
    data, off = text_bytes(column)
    kind = _CLASS[data]
    edge = np.ones(len(data), dtype=bool)
    edge[1:] = kind[1:] != kind[:-1]
    edge[off[:-1][off[:-1] < len(data)]] = True
    start = np.flatnonzero(edge)
    end = np.append(start[1:], len(data))
    full = kind[start] > 0
    start, end = start[full], end[full]
    first = np.searchsorted(start, off)
    runs = Words(data, start, end, first)
    n = len(column)
    row = runs.row()
    key, count = np.unique(row * CONTENT + (word_hashes(runs) >> _U(49)).astype(np.int64), return_counts=True)
    rows = key // CONTENT
    begin = np.searchsorted(rows, np.arange(n + 1))
    value = np.sqrt(count / np.maximum(np.diff(first), 1)[rows])

    def per_row(flags: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(flags)])
        return (total[off[1:]] - total[off[:-1]]).astype(float)

    size = np.diff(off).astype(float)
    safe = np.maximum(size, 1)
    letters = np.maximum(per_row(kind == 1), 1)
    stats = {"length": np.log2(size + 1), "signs": per_row(kind == 2) / safe * 40,
             "capitals": per_row((data >= 65) & (data < 91)) / letters * 20,
             "digits": per_row((data >= 48) & (data < 58)) / safe * 40,
             "word": letters / np.maximum(np.diff(first), 1) * 2, "lines": per_row(data == 10) / safe * 400,
             "repeats": np.diff(begin) / np.maximum(np.diff(first), 1) * 20,
             "top": np.array([count[a:b].max() if b > a else 0 for a, b in zip(begin[:-1], begin[1:])])
             / np.maximum(np.diff(first), 1) * 40}
    return Sparse(begin, key % CONTENT, value), stats


def meta_view(stats: dict[str, np.ndarray], columns: dict[str, list]) -> Sparse:
    """One feature per statistic (binned) and metadata column of each row."""
    n, out = len(stats["length"]), []
    for no, (name, values) in enumerate(stats.items()):
        out.append((no * 41 + np.clip(np.floor(values), 0, 40)).astype(np.int64))
    base = 41 * len(stats)
    for name, values in columns.items():
        cell = pa.array([f"{name}={'' if v is None else v}" if v is not None else f"{name}?" for v in values], pa.string())
        data, off = text_bytes(cell)
        h = word_hashes(Words(data, off[:-1], off[1:], np.arange(n + 1)))
        out.append(base + (h % _U(META - base)).astype(np.int64))
    index = np.stack(out, axis=1).ravel() if n else np.zeros(0, np.int64)
    width = len(out)
    return Sparse(np.arange(n + 1) * width, index, np.full(len(index), 1 / np.sqrt(width)))


def fit(x: Sparse, y: np.ndarray, weight: np.ndarray, size: int, steps: int = 80, penalty: float = 1e-4) -> np.ndarray:
    """Logistic regression (last weight: intercept) by Adam on all rows."""
    w, m, v = np.zeros(size + 1), np.zeros(size + 1), np.zeros(size + 1)
    row = np.repeat(np.arange(len(y)), np.diff(x.first))
    total, n = max(weight.sum(), 1e-9), len(y)
    for t in range(1, steps + 1):
        z = np.bincount(row, x.value * w[x.index], minlength=n) + w[-1]
        error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) * weight / total
        grad = np.append(np.bincount(x.index, x.value * error[row], minlength=size), error.sum())
        grad[:-1] += penalty * w[:-1] / 10
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        w -= 0.5 * (1 - 0.9 * t / steps) * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-8)
    return w


def _small_fit(x: np.ndarray, y: np.ndarray, steps: int = 60) -> np.ndarray:
    """Newton steps of a ridge logistic regression on a few dense columns."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + 0.5 * np.eye(len(w))
        step = np.linalg.solve(h, x.T @ (p - y) + 0.5 * w)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


class Lesson(NamedTuple):
    """Pseudo-labelled rows, as the mean rows of groups of them."""

    x: Sparse
    y: np.ndarray
    rows: np.ndarray           # rows of the group


class Model(NamedTuple):
    """Weights of the views and of their combination for one label."""

    content: np.ndarray
    meta: np.ndarray
    calibrate: np.ndarray      # per view: slope, intercept
    combine: np.ndarray        # content, meta, intercept

    def score(self, content: Sparse, meta: Sparse) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Probabilities: of each calibrated view, and combined."""
        logits = [x.times(w) + w[-1] for x, w in ((content, self.content), (meta, self.meta))]
        logits = [c[0] * z + c[1] for c, z in zip(self.calibrate, logits)]
        both = self.combine[0] * logits[0] + self.combine[1] * logits[1] + self.combine[2]
        return tuple(1 / (1 + np.exp(-np.clip(z, -30, 30))) for z in (*logits, both))


class Learner:
    """Both views of the labelled rows for one 0/1 label, and what each view
    was last taught by the other; every fifth row calibrates."""

    def __init__(self, content: Sparse, meta: Sparse, y: np.ndarray) -> None:
        self.views, self.y = (content, meta), y
        held = np.arange(len(y)) % 5 == 4
        if y[held].min() == y[held].max():
            held = np.zeros(len(y), dtype=bool)
        self.train = np.flatnonzero(~held)
        self.test = np.flatnonzero(held) if held.any() else np.arange(len(y))
        self.weights = [self._fit(no, None) for no in (0, 1)]

    def _fit(self, no: int, lesson: Lesson | None) -> np.ndarray:
        x, y = self.views[no].pick(self.train), self.y[self.train]
        weight = np.ones(len(y))
        if lesson is not None and len(lesson.y):
            # a class is taught with at most half the weight of its labelled rows
            own = np.array([(y == c).sum() for c in (0, 1)])
            found = np.array([lesson.rows[lesson.y == c].sum() for c in (0, 1)])
            scale = 0.5 * np.minimum(own, found) / np.maximum(found, 1)
            b = lesson.x
            x = Sparse(np.concatenate([x.first, b.first[1:] + x.first[-1]]), np.concatenate([x.index, b.index]),
                       np.concatenate([x.value, b.value]))
            weight = np.concatenate([weight, lesson.rows * scale[lesson.y]])
            y = np.concatenate([y, lesson.y])
        return fit(x, y, weight, (CONTENT, META)[no])

    def learn(self, lessons: tuple[Lesson, Lesson]) -> None:
        self.weights = [self._fit(no, lessons[no]) for no in (0, 1)]

    def model(self) -> Model:
        """Calibrates the views on the rows kept aside, and combines them."""
        y = self.y[self.test]
        raw = np.column_stack([v.pick(self.test).times(w) + w[-1] for v, w in zip(self.views, self.weights)])
        calibrate = np.stack([_small_fit(raw[:, [i]], y) for i in (0, 1)])
        return Model(*self.weights, calibrate, _small_fit(raw * calibrate[:, 0] + calibrate[:, 1], y))


def _constant(y: np.ndarray) -> Model:
    """Model of a label with too few rows or one class only: that class."""
    z = 4.0 * (2 * (y.mean() if len(y) else 1.0) - 1)
    return Model(np.zeros(CONTENT + 1), np.zeros(META + 1), np.array([[1.0, z], [1.0, z]]), np.array([0.5, 0.5, 0.0]))


def exchange(rows: DataFrame, weights: dict[str, list[np.ndarray]], meta_cols: Sequence[str],
             confident: float = CONFIDENT, groups: int = GROUPS) -> dict[str, tuple[Lesson, Lesson]]:
    """What each view learns from the other on all of ``rows`` (``h``, ``text``
    and metadata), for each label: a lesson for the content and one for the
    metadata view.

    One pass without a shuffle of texts: each row that a view is sure of joins
    the sums of the other view's features, by class and by ``groups`` parts of
    the hash.  The driver gets these sums alone, whose number is fixed; they
    are sums of integers, so that the layout of the rows does not matter.
    """
    shared, width = Shared(rows.sparkSession, weights), CONTENT + 1

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in blocks(batches, "text"):
            content, stats = content_view(batch.column("text"))
            views = content, meta_view(stats, {c: batch.column(c).to_pylist() for c in meta_cols})
            part = batch.column("h").to_numpy() % groups
            for t, w in enumerate(shared.value.values()):
                for giver in (0, 1):
                    z = views[giver].times(w[giver]) + w[giver][-1]
                    p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
                    for label in (0, 1):
                        sure = np.flatnonzero((p if label else 1 - p) >= confident)
                        if not len(sure):
                            continue
                        got, of = views[1 - giver].pick(sure), part[sure]
                        cell = np.repeat(of, np.diff(got.first)) * width + got.index
                        sums = np.bincount(cell, np.rint(got.value * _UNIT), minlength=groups * width).astype(np.int64)
                        sums[np.arange(groups) * width + CONTENT] = np.bincount(of, minlength=groups)
                        key = (t * 2 + 1 - giver) * 2 + label
                        total[key] = total[key] + sums if key in total else sums
        for key, sums in total.items():
            at = np.flatnonzero(sums)
            yield pa.RecordBatch.from_arrays([pa.array(key * groups * width + at), pa.array(sums[at])], ["cell", "total"])

    table = (rows.mapInArrow(run, "cell long, total long").groupBy("cell").agg(F.sum("total").alias("total"))
             .toArrow().combine_chunks().sort_by("cell"))
    cell, total = (table.column(c).to_numpy() for c in ("cell", "total"))
    out = {}
    for t, name in enumerate(weights):
        lessons = []
        for view in (0, 1):
            key, lo = (t * 2 + view) * 2 * groups, 0
            lo, hi = np.searchsorted(cell, [key * width, (key + 2 * groups) * width])
            line, index, value = cell[lo:hi] // width - key, cell[lo:hi] % width, total[lo:hi]
            counted = index == CONTENT
            there, count = line[counted], value[counted]
            line, index, value = line[~counted], index[~counted], value[~counted]
            first = np.append(np.searchsorted(line, there), len(line))
            mean = value / _UNIT / np.repeat(count, np.diff(first))
            lessons.append(Lesson(Sparse(first, index, mean), there // groups, count.astype(float)))
        out[name] = tuple(lessons)
    return out


def _features(rows: DataFrame, meta_cols: Sequence[str], extra: Sequence[str]) -> list:
    """Collects the sparse views of a bounded sample: ids stay behind."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "text"):
            content, stats = content_view(batch.column("text"))
            meta = meta_view(stats, {c: batch.column(c).to_pylist() for c in meta_cols})
            off = pa.array(content.first.astype(np.int32))
            width = len(meta.index) // max(1, batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column("h"), *[batch.column(c) for c in extra],
                 pa.ListArray.from_arrays(off, pa.array(content.index.astype(np.int32))),
                 pa.ListArray.from_arrays(off, pa.array(content.value.astype(np.float32))),
                 pa.ListArray.from_arrays(pa.array((np.arange(batch.num_rows + 1) * width).astype(np.int32)),
                                          pa.array(meta.index.astype(np.int32)))],
                ["h", *extra, "ci", "cv", "mi"])

    cols = ", ".join(f"{c} double" for c in extra)
    schema = f"h long, {cols + ',' if cols else ''} ci array<int>, cv array<float>, mi array<int>"
    table = rows.mapInArrow(run, schema).toArrow().combine_chunks().sort_by("h")
    flat = lambda c: table.column(c).combine_chunks()

    def sparse(index: str, value: str | None) -> Sparse:
        lists = flat(index)
        first = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
        idx = lists.flatten().to_numpy()
        width = max(1, int(first[1])) if len(first) > 1 else 1
        return Sparse(first, idx, flat(value).flatten().to_numpy() if value else
                      np.full(len(idx), 1 / np.sqrt(width), dtype=np.float32))

    return [sparse("ci", "cv"), sparse("mi", None), *[flat(c).to_numpy(zero_copy_only=False) for c in extra]]


def train(docs: DataFrame, labels: DataFrame, targets: Sequence[str], id_col: str = "doc_id", text_col: str = "text",
          meta_cols: Sequence[str] = ("source", "lang"), labelled_rows: int = LABELLED_ROWS, rounds: int = ROUNDS,
          groups: int = GROUPS) -> dict[str, Model]:
    """A co-trained model for each 0/1 column of ``labels`` in ``targets``.

    At most ``labelled_rows`` labelled ids, those of smallest hash, take part
    in the fit as such; all other documents are the unlabelled rows of every
    round.  Labels that are null, or whose ids are null or unknown, do not
    count; of different labels of one id the smallest counts, and of
    several documents of one labelled id the smallest by its columns.  The
    models do not depend on the order or the partitioning of the rows.
    """
    marks = labels.select(F.col(id_col).alias("id"), *[F.col(t).cast("double").alias(t) for t in targets]).dropna()
    marks = marks.groupBy("id").agg(*[F.min(t).alias(t) for t in targets]).withColumn("h", F.xxhash64("id"))
    marks = checkpointed(sample(marks, "h", labelled_rows))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), *meta_cols)
    known = rows.join(F.broadcast(marks), "id").groupBy("id", "h", *targets).agg(
        F.min(F.struct("text", *meta_cols)).alias("row")).select("id", "h", *targets, "row.*")
    others = rows.join(F.broadcast(marks.select("id")), "id", "left_anti").select(
        F.xxhash64("id").alias("h"), "text", *meta_cols)
    content, meta, *ys = _features(known, meta_cols, targets)
    learners = {t: Learner(content, meta, y) for t, y in zip(targets, ys) if len(y) >= 10 and y.min() < y.max()}
    for _ in range(rounds if learners else 0):
        lessons = exchange(others, {t: x.weights for t, x in learners.items()}, meta_cols, groups=groups)
        for t, learner in learners.items():
            learner.learn(lessons[t])
    return {t: learners[t].model() if t in learners else _constant(y) for t, y in zip(targets, ys)}


def score_rows(models: dict[str, Model], batch: pa.RecordBatch, text_col: str,
               meta_cols: Sequence[str]) -> dict[str, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    content, stats = content_view(batch.column(text_col))
    meta = meta_view(stats, {c: batch.column(c).to_pylist() for c in meta_cols})
    return {t: m.score(content, meta) for t, m in models.items()}


def _keep(got: dict[str, tuple[np.ndarray, ...]], want: dict[str, float]) -> np.ndarray:
    """Rows whose combined scores say what ``want`` asks: 1 at least one half,
    0 under one half."""
    ok = [(got[t][2] >= 0.5) == bool(v) for t, v in want.items()]
    return np.logical_and.reduce(ok)


def classify(docs: DataFrame, models: dict[str, Model], want: dict[str, float], id_col: str = "doc_id",
             text_col: str = "text", meta_cols: Sequence[str] = ("source", "lang")) -> DataFrame:
    """Scores of every whole text.

    Returns ``id``, for each label ``<label>_content``, ``<label>_meta`` and
    ``<label>_score`` (probabilities of the calibrated views and combined), and
    ``keep``.  Null texts count as empty, null metadata as a value of its own.
    Repeated rows get equal scores; an empty table gives no rows.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), *meta_cols)
    shared = Shared(docs.sparkSession, models)
    kind = rows.schema["id"].dataType.simpleString()
    names = [f"{t}_{v}" for t in models for v in ("content", "meta", "score")]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "text"):
            got = score_rows(shared.value, batch, "text", meta_cols)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), *[pa.array(p) for t in got for p in got[t]], pa.array(_keep(got, want))],
                ["id", *names, "keep"])

    return rows.mapInArrow(run, f"id {kind}, {', '.join(f'{n} double' for n in names)}, keep boolean")


def keep_good(docs: DataFrame, models: dict[str, Model], want: dict[str, float], text_col: str = "text",
              meta_cols: Sequence[str] = ("source", "lang")) -> DataFrame:
    """The rows of ``docs`` that :func:`classify` keeps, all columns kept.

    Null texts count as empty ones; repeated rows are kept or go together; an
    empty table stays empty.  Columns may have any name, as only the text and
    the metadata columns are read.
    """
    shared = Shared(docs.sparkSession, models)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, text_col):
            yield batch.filter(pa.array(_keep(score_rows(shared.value, batch, text_col, meta_cols), want)))

    return docs.mapInArrow(run, docs.schema)
