"""Numpy kernels over Arrow text columns, shared by the operators.

Words are maximal runs of bytes other than space and TAB..CR.  All of these
bytes are ASCII, so cutting UTF-8 bytes cuts code points rightly.  Nulls count
as empty texts.  A block holds whole rows; a row is never cut.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Text bytes worked on at once; bounds the memory of the kernels (a single
#: longer text is still taken whole).
BLOCK_BYTES = 2 << 20

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 5          # odd, so it has an inverse modulo 2^64
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_BYTE = np.random.default_rng(20240607).integers(1, 2**64 - 1, 256, dtype=np.uint64)
_POWERS = np.ones(1, dtype=np.uint64)
_INVERSE = np.ones(1, dtype=np.uint64)


class Words(NamedTuple):
    """Words of a block: byte range of each, and each row's first word."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray       # len(rows) + 1

    def row(self) -> np.ndarray:
        """Row number of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def blocks(batches: Iterable[pa.RecordBatch], text: str,
           limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about ``limit`` bytes of ``text`` each."""
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        at = np.concatenate([[0], np.cumsum(size, dtype=np.int64)])
        lo = 0
        while lo < batch.num_rows:
            hi = max(lo + 1, int(np.searchsorted(at, at[lo] + limit, side="right")) - 1)
            yield batch.slice(lo, hi - lo)
            lo = hi


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column and the row offsets into them."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[off[0]:off[-1]], off - off[0]


def words(column: pa.Array, lower: bool = False, gap: np.ndarray = _SPACE) -> Words:
    """Word ranges of a text column; ``lower`` maps A-Z to a-z first, ``gap``
    marks the bytes that belong to no word."""
    data, off = text_bytes(column)
    if lower:
        data = _LOWER[data]
    inside = ~gap[data]
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    filled = off[1:] > off[:-1]
    heads, tails = off[:-1][filled], off[1:][filled] - 1
    opens[heads] = inside[heads]
    closes[tails] = inside[tails]
    start = np.flatnonzero(opens)
    return Words(data, start, np.flatnonzero(closes) + 1, np.searchsorted(start, off))


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (all bits depend on all bits)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _POWERS, _INVERSE
    if len(_POWERS) < n:
        size = max(n, 2 * len(_POWERS))
        for name, base in (("_POWERS", _BASE), ("_INVERSE", pow(_BASE, -1, 2**64))):
            table = np.full(size, base, dtype=np.uint64)
            table[0] = 1
            globals()[name] = np.cumprod(table, dtype=np.uint64)
    return _POWERS, _INVERSE


def _sums(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    power, inverse = _powers(len(values) + 1)
    total = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * power[:len(values)], out=total[1:])
    return total, inverse


def word_hashes(w: Words) -> np.ndarray:
    """64-bit hash of every word."""
    total, inverse = _sums(_BYTE[w.data])
    length = (w.end - w.start).astype(np.uint64)
    return mix((total[w.end] - total[w.start]) * inverse[w.start] + length * _U(0x632BE59BD9B4E019))


def rolling(hashes: np.ndarray, k: int) -> np.ndarray:
    """64-bit hash of every ``k`` consecutive values (``len - k + 1`` of them,
    across rows too; the caller keeps those inside a row)."""
    if len(hashes) < k:
        return np.zeros(0, dtype=np.uint64)
    total, inverse = _sums(hashes)
    return mix((total[k:] - total[:-k]) * inverse[:len(hashes) - k + 1] + _U(k))


def starts_inside(first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Word positions at which ``k`` words of one row begin, and their rows."""
    count = np.maximum(np.diff(first) - k + 1, 0)
    row = np.repeat(np.arange(len(count)), count)
    begin = np.concatenate([[0], np.cumsum(count)])[:-1]
    return np.arange(count.sum()) - begin[row] + first[:-1][row], row


def sliding_min(values: np.ndarray, k: int) -> np.ndarray:
    """Minimum of every ``k`` consecutive values, by doubling."""
    out, have = values, 1
    while have < k and len(out):
        step = min(have, k - have)
        out = np.minimum(out[:-step], out[step:]) if len(out) > step else out[:0]
        have += step
    return out


def ranges(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges [lo, hi), one after the other, and the range
    of each."""
    size = np.maximum(hi - lo, 0)
    of = np.repeat(np.arange(len(lo)), size)
    return np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + lo[of], of


def join_words(w: Words, at: np.ndarray, first: np.ndarray) -> pa.Array:
    """Texts of the words ``at`` joined by one space; text r has the words
    first[r] to first[r + 1] of ``at``."""
    size = (w.end - w.start)[at] + 1
    last = first[1:][np.diff(first) > 0] - 1
    size[last] -= 1                                        # no space behind the last word
    off = np.concatenate([[0], np.cumsum(size)])
    source = np.arange(off[-1]) - np.repeat(off[:-1] - w.start[at], size)
    out = w.data[np.minimum(source, max(len(w.data) - 1, 0))] if len(w.data) else w.data
    gap = np.ones(len(at), dtype=bool)
    gap[last] = False
    out[off[1:][gap] - 1] = 32
    return pa.Array.from_buffers(pa.large_string(), len(first) - 1,
                                 [None, pa.py_buffer(off[first].astype(np.int64)), pa.py_buffer(out)]).cast(pa.string())
