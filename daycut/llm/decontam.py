"""Benchmark decontamination by the q-gram lemma.

A text that holds a passage of length L with at most e edits shares at least
``L + 1 - q - q * e`` q-grams with it, all within e + 1 diagonals.  The q-grams
that a document shares with the benchmark are counted per item in overlapping
bands of diagonals; bands that meet the bound are verified by an alignment of
the whole item inside the band.  Every item is searched with its full budget:
where it leaves no q-gram of ``Q`` bytes, smaller ones are counted, and items
under ``Q`` bytes, which allow no edits, are found whole by an automaton.

Texts are compared as UTF-8 bytes with case folded over all of Unicode (each
code point by ``str.casefold``) and each run of white space as one space; edits
are edits of these bytes.  Documents never move: the index of the benchmark goes
to them, in blocks of a fixed size.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Shared
from .textkit import _LOWER, _SPACE, blocks, mix, ranges, text_bytes

Q = 14
#: Size for items whose edits may leave no q-gram of ``Q`` bytes: enough for all
#: of ``Q`` bytes or more, as an item of 20 e bytes has e edits.
SMALL_Q = 10
#: Edits allowed, as a share of the item's length.
EDIT_SHARE = 0.05
#: Benchmark bytes indexed and broadcast at once; a larger benchmark takes
#: several passes over the documents.
INDEX_BYTES = 16 << 20
_BITS = 22
#: Cells of the alignment looked at in one step.
_CELLS = 1 << 20
_U = np.uint64
_WORDLIKE = np.array([c >= 128 or chr(c).isalnum() for c in range(256)])
_FOLD: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None


def _fold_table() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of every code point, the number of its folded form (0: stays as it is);
    of every form, its bytes and how many there are."""
    global _FOLD
    if _FOLD is None:
        number = np.zeros(0x110000, dtype=np.int16)
        forms = [b""]
        for c in range(0x80, 0x20000):
            if not 0xD800 <= c < 0xE000 and chr(c).casefold() != chr(c):
                number[c] = len(forms)
                forms.append(chr(c).casefold().encode())
        size = np.array([len(f) for f in forms], dtype=np.int64)
        table = np.zeros((len(forms), size.max()), dtype=np.uint8)
        for no, f in enumerate(forms):
            table[no, :len(f)] = list(f)
        _FOLD = number, table, size
    return _FOLD


def fold(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes with case folded, row offsets into them, and the old place of
    each; a form longer or shorter than its code point ends where that ends."""
    out, same = _LOWER[data], np.arange(len(data))
    lead = np.flatnonzero(data >= 0xC0)
    if not len(lead):
        return out, off, same
    number, table, size = _fold_table()
    wide = np.concatenate([data, np.zeros(3, np.uint8)]).astype(np.int32)
    a, b, c, d = wide[lead], *(wide[lead + i] & 63 for i in (1, 2, 3))
    length = 2 + (a >= 0xE0) + (a >= 0xF0)
    code = np.select([length == 2, length == 3], [(a & 31) << 6 | b, (a & 15) << 12 | b << 6 | c],
                     (a & 7) << 18 | b << 12 | c << 6 | d)
    form = number[np.minimum(code, 0x10FFFF)]
    lead, length, form = lead[form > 0], length[form > 0], form[form > 0]
    new = size[form]
    if (new != length).any():
        count = np.ones(len(data), dtype=np.int64)
        for i in (1, 2, 3):
            count[lead[length > i] + i] = 0
        count[lead] = new
        at = np.concatenate([[0], np.cumsum(count)])
        same = np.repeat(same, count)
        out = out[same]
        put, off = at[lead], at[off]
    else:
        put = lead
    for i in range(table.shape[1]):
        has = new > i
        out[put[has] + i] = table[form[has], i]
        same[put[has] + i] = lead[has] + np.where(i == new[has] - 1, length[has] - 1, np.minimum(i, length[has] - 1))
    return out, off, same


def normal(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Normalised bytes, row offsets into them, and the old place of each."""
    data, off, old = fold(data, off)
    space = _SPACE[data]
    keep = ~space
    keep[1:] |= ~space[:-1]
    heads = off[:-1][off[1:] > off[:-1]]
    keep[heads] = True
    at = np.flatnonzero(keep)
    out = data[at]
    out[space[at]] = 32
    return out, np.searchsorted(at, off), old[at]


def qgrams(data: np.ndarray, sizes: Sequence[int]) -> list[np.ndarray]:
    """For each of the rising ``sizes``, the hash of so many bytes at every place."""
    wide, out, acc = data.astype(np.uint64), [], np.zeros(len(data), dtype=np.uint64)
    for i in range(sizes[-1]):
        n = max(len(data) - i, 0)
        acc = acc[:n] * _U(0x100000001B3) + wide[i:i + n]
        if i + 1 in sizes:
            out.append(mix(acc))
    return out


class Grams:
    """q-grams of one size of some benchmark items, sorted by hash."""

    def __init__(self, size: int, texts: dict[int, bytes]) -> None:
        self.size = size
        grams = [qgrams(np.frombuffer(t, np.uint8), (size,))[0] for t in texts.values()]
        gram = np.concatenate([*grams, np.zeros(0, np.uint64)])
        order = np.argsort(gram, kind="stable")
        self.gram = gram[order]
        self.item = np.repeat(np.array(list(texts), dtype=np.int32), [len(g) for g in grams])[order]
        self.place = np.concatenate([*[np.arange(len(g), dtype=np.int32) for g in grams], np.zeros(0, np.int32)])[order]
        self.filter = np.zeros(1 << _BITS, dtype=bool)
        self.filter[(self.gram >> _U(64 - _BITS)).astype(np.int64)] = True

    def shared(self, gram: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, ...]:
        """Row, item, place in the item and diagonal of each q-gram that the
        rows (which end at ``off``) share with an item."""
        at = np.flatnonzero(self.filter[(gram >> _U(64 - _BITS)).astype(np.int64)])
        lo, hi = (np.searchsorted(self.gram, gram[at], side=s) for s in ("left", "right"))
        row = np.searchsorted(off, at, side="right") - 1
        live = (hi > lo) & (at + self.size <= off[row + 1])
        at, row = at[live], row[live]
        entry, pick = ranges(lo[live], hi[live])
        place = self.place[entry].astype(np.int64)
        return row[pick], self.item[entry].astype(np.int64), place, at[pick] - off[row[pick]] - place


class Index:
    """Some benchmark items: q-grams of those that allow for edits, and an
    automaton of those too short for a q-gram."""

    def __init__(self, items: list[tuple[int, bytes]]) -> None:
        self.items = items
        length = np.array([len(t) for _, t in items], dtype=np.int64)
        self.edits = (length * EDIT_SHARE).astype(np.int64)
        # the largest size of which an item within its edits keeps one q-gram
        size = np.where(length >= Q * (self.edits + 1), Q, SMALL_Q)
        self.need = length + 1 - size - size * self.edits
        self.band = 2 * self.edits + 2
        levels = {q: {no: items[no][1] for no in np.flatnonzero((size == q) & (length >= Q)).tolist()} for q in (SMALL_Q, Q)}
        self.levels = [Grams(q, texts) for q, texts in levels.items() if texts]
        self.short = None
        short: dict[str, list[int]] = {}
        for no in np.flatnonzero(length < Q).tolist():
            short.setdefault(items[no][1].decode("latin-1"), []).append(no)
        if short:
            self.short = ahocorasick.Automaton()
            for text, numbers in short.items():
                self.short.add_word(text, (len(text), tuple(numbers)))
            self.short.make_automaton()


def _slide(row: np.ndarray, diagonal: np.ndarray, last: np.ndarray, item: np.ndarray, text: np.ndarray) -> None:
    """Moves each diagonal's row down over equal bytes, at most to ``last``."""
    live, step = np.flatnonzero((row >= 0) & (row < last)), 1
    while len(live):
        i = row[live][:, None] + np.arange(step)
        same = i < last[live][:, None]
        same &= item[np.minimum(i, len(item) - 1)] == text[np.minimum(i + diagonal[live][:, None], len(text) - 1)]
        run = np.where(same.all(1), step, np.argmin(same, axis=1))
        row[live] += run
        live = live[run == step]
        step = min(4 * step, max(4, _CELLS // max(len(live), 1)))


def align(item: np.ndarray, text: np.ndarray, low: int, high: int, limit: int) -> tuple[int, int, int] | None:
    """Fewest edits of ``item`` against any part of ``text`` on the diagonals
    from ``low`` to ``high`` (exclusive) and ``limit`` beyond each side:
    (edits, start, stop), or None beyond ``limit``.  Ties go to the part that
    ends first.

    Only the band is worked on: for 0, 1, 2, ... edits, the furthest byte of
    the item that each diagonal reaches.
    """
    m, n, nowhere = len(item), len(text), -(1 << 40)
    diagonal = np.arange(max(low - limit, -limit), min(high + limit, n - m + limit + 1))
    if not len(diagonal):
        return None
    last = np.minimum(m, n - diagonal)
    row, begin = np.where(diagonal >= 0, 0, nowhere), diagonal.copy()
    for edits in range(limit + 1):
        if edits:
            # an item byte changed, a text byte more, an item byte less
            ways = np.full((3, len(row)), nowhere)
            ways[0] = np.minimum(row + 1, last)
            ways[1, 1:] = np.where(row[:-1] <= last[1:], row[:-1], nowhere)
            ways[2, :-1] = row[1:] + 1
            best = np.argmax(ways, axis=0)
            row = np.take_along_axis(ways, best[None], axis=0)[0]
            begin = begin[np.clip(np.arange(len(row)) + np.array([0, -1, 1])[best], 0, len(row) - 1)]
        _slide(row, diagonal, last, item, text)
        done = np.flatnonzero(row >= m)
        if len(done):
            return edits, int(begin[done[0]]), m + int(diagonal[done[0]])
    return None


def _short_matches(index: Index, data: np.ndarray, off: np.ndarray) -> dict[tuple[int, int], tuple[int, int, int]]:
    """First place of each item under ``Q`` bytes that stands in a row as whole
    words: a letter or digit at its edge has none beside it."""
    found: dict[tuple[int, int], tuple[int, int, int]] = {}
    for end, (size, numbers) in index.short.iter(data.tobytes().decode("latin-1")):
        at, end = end + 1 - size, end + 1
        row = int(np.searchsorted(off, at, side="right")) - 1
        lo, hi = int(off[row]), int(off[row + 1])
        if end > hi or (row, numbers[0]) in found:
            continue
        if at > lo and _WORDLIKE[data[at]] and _WORDLIKE[data[at - 1]]:
            continue
        if end < hi and _WORDLIKE[data[end - 1]] and _WORDLIKE[data[end]]:
            continue
        for no in numbers:
            found[row, no] = 0, at - lo, end - lo
    return found


def find(index: Index, column: pa.Array) -> list[tuple[int, int, int, int, int]]:
    """Matches in a block of texts: row, item number, edits, and the byte
    range in the text.  The best match per row and item (fewest edits, first)."""
    raw, raw_off = text_bytes(column)
    data, off, old = normal(raw, raw_off)
    best = _short_matches(index, data, off) if index.short else {}
    sizes = [g.size for g in index.levels]
    for level, gram in zip(index.levels, qgrams(data, sizes) if sizes else []):
        row, item, place, diagonal = level.shared(gram, off)
        for shift in (0, 1):                                   # bands overlap by half
            if not len(row):
                break
            half = index.band[item] // 2
            band = (diagonal + shift * half) // index.band[item]
            order = np.lexsort((place, band, item, row))
            r, i, b, p = row[order], item[order], band[order], place[order]
            first = np.ones(len(r), dtype=bool)
            first[1:] = (r[1:] != r[:-1]) | (i[1:] != i[:-1]) | (b[1:] != b[:-1])
            fresh = first.copy()
            fresh[1:] |= p[1:] != p[:-1]
            start = np.flatnonzero(first)
            shared = np.add.reduceat(fresh.astype(np.int64), start)
            for s in start[shared >= index.need[i[start]]]:
                no, of = int(i[s]), int(r[s])
                width = int(index.band[no])
                low = int(b[s]) * width - shift * (width // 2)
                got = align(np.frombuffer(index.items[no][1], np.uint8), data[off[of]:off[of + 1]], low, low + width,
                            int(index.edits[no]))
                if got:
                    best[of, no] = min(best.get((of, no), got), got)
    out = []
    for (of, no), (edits, lo_at, hi_at) in sorted(best.items()):
        base = int(off[of])
        out.append((of, no, edits, int(old[base + lo_at] - raw_off[of]), int(old[base + hi_at - 1] + 1 - raw_off[of])))
    return out


def index_blocks(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text",
                 limit: int = INDEX_BYTES) -> Iterator[Index]:
    """Indexes of all items, each of at most about ``limit`` bytes of text.

    Null texts and those of white space alone are no items.  The benchmark is
    read in blocks by hash, one after the other, so that the driver holds one
    block at a time.
    """
    rows = benchmark.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).where("text IS NOT NULL")
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-total // limit))
    for part in range(parts):
        got = rows.where(F.pmod(F.xxhash64("id", "text"), F.lit(parts)) == part).distinct().orderBy("id", "text").collect()
        items = []
        for r in got:
            data, off = text_bytes(pa.array([r["text"].strip(" \t\n\v\f\r")]))
            text = normal(data, off)[0].tobytes()
            if text:
                items.append((-1 if r["id"] is None else r["id"], text))
        yield Index(items)


def indexes(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text",
            limit: int = INDEX_BYTES) -> list[Index]:
    """All of :func:`index_blocks` at once."""
    return list(index_blocks(benchmark, id_col, text_col, limit))


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Benchmark items found in the whole texts of ``docs``.

    Returns ``id``, ``item_id`` (-1 for null), ``edits``, ``start``, ``stop``
    (code points of the text, end exclusive): the best match of each row and
    item.  Items under ``Q`` bytes count where they stand as whole words.  Null and empty texts match nothing; repeated rows each give their
    rows; with an empty benchmark there are none.  Other columns are ignored.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    spark, out = docs.sparkSession, None
    for index in index_blocks(benchmark):
        shared = Shared(spark, index)

        def run(batches: Iterable[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in blocks(batches, "text"):
                got = find(shared.value, batch.column("text"))
                texts = {r: (batch.column("text")[r].as_py() or "").encode() for r in {g[0] for g in got}}
                points = [[len(texts[g[0]][:x].decode("utf-8", "ignore")) for x in g[3:]] for g in got]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").take(pa.array([g[0] for g in got], pa.int64())),
                     pa.array([shared.value.items[g[1]][0] for g in got], pa.int64()),
                     pa.array([g[2] for g in got], pa.int64()), pa.array([p[0] for p in points], pa.int64()),
                     pa.array([p[1] for p in points], pa.int64())], ["id", "item_id", "edits", "start", "stop"])

        part = rows.mapInArrow(run, f"id {kind}, item_id long, edits long, start long, stop long")
        out = part if out is None else out.union(part)
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, all columns kept.

    Null and empty texts hold none; repeated rows are kept or go together.
    With an empty benchmark, or an empty ``docs``, all rows are kept.  Other
    columns may have any name.
    """
    for index in index_blocks(benchmark):
        shared = Shared(docs.sparkSession, index)

        def run(batches: Iterable[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in blocks(batches, text_col):
                clean = np.ones(batch.num_rows, dtype=bool)
                clean[[g[0] for g in find(shared.value, batch.column(text_col))]] = False
                yield batch.filter(pa.array(clean))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
