"""Language identification by language-bitmask n-gram filters.

One Bloom filter per language, bit-sliced: cell ``i`` of the table holds a
mask with bit ``l`` set if bit ``i`` of language ``l``'s filter is set.  One
probe (the AND of the cells of an n-gram) returns all languages that contain
the n-gram.  A text is decided by the count of its n-grams per language, each
corrected for the rate of false positives of that language's filter.

Grams are runs of 3 and 4 code points of the lower-cased text, in which every run
of other signs than letters is one space; they include the spaces at both ends
of a word.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daycut.session import checkpointed

from .common import Shared, sample_each
from .textkit import blocks, mix

SIZES = (3, 4)
#: Cells of the table; fixes the size of what is broadcast (8 bytes a cell
#: and 64 languages).
CELLS = 1 << 19
PROBES = 2
#: Labelled rows the filters are learned from: those of smallest hash of each
#: language.
SAMPLE_ROWS = 24_000
#: An n-gram belongs to a language if this share of its n-grams is it.
MIN_SHARE = 4e-5
_U = np.uint64
_LETTER: np.ndarray | None = None


def _letter_table() -> np.ndarray:
    global _LETTER
    if _LETTER is None:
        _LETTER = np.fromiter((chr(c).isalpha() for c in range(0x10000)), dtype=bool, count=0x10000)
    return _LETTER


def grams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all n-grams of a block of texts, and the row of each.

    A text without a letter has none.
    """
    joined = "".join(f"\0 {t} " for t in ((t or "").replace("\0", " ") for t in texts)).lower()
    code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letter_table()[np.minimum(code, 0xFFFF)]
    for c in np.unique(code[code > 0xFFFF]).tolist():
        letter[code == c] = chr(c).isalpha()
    mark = code == 0
    keep = letter | mark
    keep[1:] |= (letter | mark)[:-1]            # the first of a run of other signs
    space = ~(letter | mark)[keep]
    code = code[keep].astype(np.uint64)
    code[space] = 32
    row = np.cumsum(code == 0) - 1
    hashes, rows, acc = [], [], np.zeros(len(code), dtype=np.uint64)
    for n in range(1, SIZES[-1] + 1):
        if len(code) < n:
            break
        acc = acc[:len(code) - n + 1] * _U(0x200000) + code[n - 1:]
        if n in SIZES:
            inside = (row[n - 1:] == row[:len(row) - n + 1]) & (code[:len(code) - n + 1] > 0)
            hashes.append(mix(acc[inside] + _U(n)))
            rows.append(row[:len(row) - n + 1][inside])
        if n == 3:                              # 63 bits are full
            acc = mix(acc)
    return np.concatenate(hashes or [np.zeros(0, np.uint64)]), np.concatenate(rows or [np.zeros(0, np.int64)])


def _cells(grams: np.ndarray) -> list[np.ndarray]:
    step = (grams >> _U(32)) | _U(1)
    return [((grams + _U(i) * step) & _U(CELLS - 1)).astype(np.int64) for i in range(PROBES)]


def learn(labelled: DataFrame, text_col: str, lang_col: str, sample_rows: int = SAMPLE_ROWS,
          min_share: float = MIN_SHARE) -> tuple[list[str], np.ndarray]:
    """Languages and bit-sliced filter (planes x cells) of labelled rows.

    Rows without a language or without a text teach nothing.  At most
    ``sample_rows`` rows of different texts are used, of each language those of
    smallest hash; languages share them evenly, and a rare one has all its rows
    taken.  The grams
    are counted and thresholded in Spark; the driver gets set cells only, of
    which there are at most ``CELLS`` a plane.
    """
    rows = (labelled.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
            .where("lang IS NOT NULL AND text IS NOT NULL"))
    rows = rows.withColumn("h", F.xxhash64("text", "lang"))
    # a list of hashes of that bounded length moves, not the texts
    taken = checkpointed(sample_each(rows, "lang", "h", sample_rows).select("h"))
    rows = rows.join(F.broadcast(taken), "h", "left_semi").dropDuplicates(["h"])

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "text"):
            found, row = grams(batch.column("text").to_pylist())
            langs = np.array(batch.column("lang").to_pylist(), dtype=object)
            for lang in sorted(set(langs)):
                gram, n = np.unique(found[(langs == lang)[row]], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(gram), pa.string()), pa.array(gram.view(np.int64)), pa.array(n.astype(np.int64))],
                    ["lang", "gram", "n"])

    counts = checkpointed(rows.select("lang", "text").repartition(64).mapInArrow(count, "lang string, gram long, n long")
                          .groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    total = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    kept = counts.join(total, "lang").where(F.col("n") >= F.col("total") * min_share)

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            gram = batch.column("gram").to_numpy().view(np.uint64)
            lang = batch.column("lang")
            for cell in _cells(gram):
                yield pa.RecordBatch.from_arrays([lang, pa.array(cell.astype(np.int32))], ["lang", "cell"])

    set_cells = (kept.select("lang", "gram").mapInArrow(place, "lang string, cell int")
                 .groupBy("lang").agg(F.collect_set("cell").alias("cells")).collect())
    langs = sorted(r["lang"] for r in set_cells)
    planes = np.zeros((max(1, -(-len(langs) // 64)), CELLS), dtype=np.uint64)
    for r in set_cells:
        no = langs.index(r["lang"])
        planes[no // 64][np.array(r["cells"], dtype=np.int64)] |= _U(1) << _U(no % 64)
    return langs, planes


def _false_rates(langs: list[str], planes: np.ndarray) -> np.ndarray:
    fill = [np.mean((planes[i // 64] >> _U(i % 64)) & _U(1)) for i in range(len(langs))]
    return np.array(fill) ** PROBES


def identify(docs: DataFrame, id_col: str, text_col: str, model: tuple[list[str], np.ndarray],
             keep: dict[str, Column] | None = None) -> DataFrame:
    """Language of every whole text.

    Returns a row per row of ``docs``: ``id``, the ``keep`` columns,
    ``lang_pred`` and ``score``.  ``score`` (0 to 1) is the best language's
    share of the text's n-grams after the correction for false positives.
    ``und`` with score 0: null text, text without a letter, or nothing
    learned.  Ties, also texts of which no language knows an n-gram, go to the
    first language by name.  Only the text is read.  An empty table gives no rows.
    """
    keep = keep or {}
    langs, planes = model
    false = _false_rates(langs, planes)
    spark = docs.sparkSession
    shared = Shared(spark, (langs, planes, false))
    rows = docs.select(F.col(id_col).alias("id"), *[c.alias(n) for n, c in keep.items()], F.col(text_col).alias("text"))
    schema = [f for f in rows.schema.fields if f.name != "text"]
    names = [f.name for f in schema]
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema) + ", lang_pred string, score double"

    def decide(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Best language and its share of each text, and the n-grams it has."""
        langs, planes, false = shared.value
        gram, row = grams(texts)
        total = np.bincount(row, minlength=len(texts))
        cells = _cells(gram)
        part = np.zeros((max(1, len(langs)), len(texts)))
        for p, plane in enumerate(planes):
            mask = plane[cells[0]]
            for cell in cells[1:]:
                mask = mask & plane[cell]
            for bit in range(min(64, len(langs) - 64 * p)):
                hit = np.bincount(row[(mask >> _U(bit)) & _U(1) > 0], minlength=len(texts)) / np.maximum(total, 1)
                no = 64 * p + bit
                part[no] = np.clip((hit - false[no]) / max(1 - false[no], 1e-9), 0, 1)
        best = part.argmax(0)
        return best, part[best, np.arange(len(texts))], total

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "text"):
            langs = shared.value[0]
            best, share, total = decide(batch.column("text").to_pylist())
            known = (total > 0) & bool(langs)
            yield pa.RecordBatch.from_arrays(
                [batch.column(n) for n in names]
                + [pa.array([langs[i] if k else "und" for i, k in zip(best, known)], pa.string()),
                   pa.array(np.where(known, share, 0.0))], [*names, "lang_pred", "score"])

    return rows.mapInArrow(run, ddl)
