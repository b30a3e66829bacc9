"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source should be taken ``target / source size`` times.
The whole part is fixed; the fractional copy probabilities are rounded in
pairs: mass moves from one document to the other, at random but without
changing the words expected, until one of the two probabilities is 0 or 1.
Pairs are formed inside bounded chunks of a source; what stays open in a chunk
(one document) meets the residuals of 64 chunks on the next level, and so on up
a reduction tree until one document of each source is left, which is rounded
alone.  So a source misses its target by at most one document, a
small one as a rule.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daycut.session import checkpointed

from .common import WORD
from .textkit import mix

CHUNK = 4096
FANOUT = 64
_OPEN = "no long, k1 long, k2 long, copy long, size long, chunk long, x double, open boolean"


def source_targets(sizes: DataFrame, weights: Sequence[int] = (1, 2, 3), max_repeat: int = 3) -> DataFrame:
    """Target words of each source.

    ``sizes``: ``source``, ``source_size``, ``docs``, one row a source.  The
    sources by code point, null last, weigh ``weights`` in turn and share the
    sum of all sizes; no target exceeds ``max_repeat`` times its source's
    size, and the excess goes to the others by weight.  In closed form: order
    the sources by cap over weight; the first ones are capped, and the rest
    share what remains at one rate.  The windows run over one row a source.
    """
    every = Window.partitionBy(F.lit(0))
    by_name = Window.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.col("no") % len(weights) + 1).cast("int"))
    rows = (sizes.withColumn("no", F.row_number().over(by_name).cast("long") - 1)
            .withColumns({"weight": weight, "cap": F.col("source_size") * max_repeat})
            .withColumn("ratio", F.col("cap") / F.col("weight")))
    before = Window.partitionBy(F.lit(0)).orderBy("ratio", "no").rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    share = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    rows = rows.withColumn("rate", left / share)
    rate = F.min(F.when(F.col("rate") <= F.col("ratio"), F.struct("ratio", "no", "rate"))).over(every)["rate"]
    return rows.withColumn("all_rate", rate).select(
        "source", "no", "source_size", "docs",
        F.least(F.col("cap").cast("double"), F.col("all_rate") * F.col("weight")).alias("target"))


def _unit(k2: np.ndarray, copy: np.ndarray, seed: int) -> np.ndarray:
    """A number in [0, 1) for each row, the same on every run."""
    word = mix(k2.astype(np.int64).view(np.uint64) ^ (copy.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
               ^ np.uint64(seed & (2**64 - 1)))
    return (word >> np.uint64(11)).astype(float) / 2.0**53


def pivot(rows: pd.DataFrame, seed: int) -> pd.DataFrame:
    """Rounds one chunk: all but at most one ``x`` become 0 or 1; the sum of
    ``size * x`` stays, and each ``x`` keeps its value in expectation.  The
    largest come first, so what stays open is small."""
    rows = rows.sort_values(["size", "k1", "k2", "copy"], ascending=[False, True, True, True], ignore_index=True)
    x, size = rows["x"].tolist(), rows["size"].tolist()
    chance = _unit(rows["k2"].to_numpy(), rows["copy"].to_numpy(), seed).tolist()
    still = [0.0 < v < 1.0 for v in x]
    at = -1
    for j in range(len(x)):
        if not still[j]:
            continue
        if at < 0:
            at = j
            continue
        i, back = at, size[j] / size[at]
        up = min(1.0 - x[i], x[j] * back)          # i takes mass from j
        down = min(x[i], (1.0 - x[j]) * back)      # i gives mass to j
        step = up if chance[j] * (up + down) < down else -down
        x[i] += step
        x[j] -= step / back
        for k in (i, j):
            if x[k] < 1e-9 or x[k] > 1 - 1e-9:
                x[k], still[k] = float(round(x[k])), False
        at = i if still[i] else j if still[j] else -1
    return rows.assign(x=x, open=still)


def _rounder(seed: int):
    return lambda rows: pivot(rows, seed)


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                weights: Sequence[int] = (1, 2, 3), max_repeat: int = 3, chunk: int = CHUNK,
                fanout: int = FANOUT, seed: int = 7) -> DataFrame:
    """How often each document goes into the mix.

    Returns a row per document: ``id``, ``k1``, ``k2`` (key of the id and
    text), ``source``, ``size`` (words; null text: 0), ``source_size``,
    ``target`` (words, of the source), ``copies`` (0 to ``max_repeat``) and
    ``taken`` = copies * size.  Documents without words and sources without
    words take 0 copies.  A null source is a source of its own.  Repeated rows
    count, and are decided, one by one; which of several identical rows gets a
    copy is of no consequence, and reruns give the same rows.  An empty table
    gives no rows.  Other columns are ignored.
    """
    counted = docs.select(
        F.col(id_col).alias("id"), F.col(source_col).alias("source"), F.xxhash64(id_col, source_col).alias("k1"),
        F.xxhash64(id_col, text_col, F.col(text_col).isNull()).alias("k2"),
        F.coalesce(F.regexp_count(text_col, F.lit(WORD)), F.lit(0)).cast("long").alias("size"))
    # the texts are read once; identical rows travel as one row with a count
    counted = checkpointed(counted.groupBy("id", "source", "k1", "k2", "size").agg(F.count(F.lit(1)).alias("rows")))
    targets = checkpointed(source_targets(
        counted.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).alias("source_size"),
                                      F.sum("rows").alias("docs")), weights, max_repeat))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    rows = (counted.join(targets.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")))
            .drop("of")
            .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows")))).drop("rows")
            .withColumn("rate", F.when(F.col("size") > 0, rate).otherwise(0.0))
            .withColumn("whole", F.floor("rate"))
            .withColumn("x", F.col("rate") - F.col("whole")))

    level = rows.where("x > 0").select(
        "no", "k1", "k2", "copy", "size",
        F.pmod(F.xxhash64("k2", "copy"), F.ceil(F.col("docs") / chunk)).alias("chunk"), "x")
    most = targets.agg(F.max("docs")).first()[0] or 0
    chunks, step, closed = math.ceil(most / chunk), 0, []
    while True:
        out = checkpointed(level.groupBy("no", "chunk").applyInPandas(_rounder(seed + step), _OPEN))
        closed.append(out.where("not open"))
        level = out.where("open").drop("open").withColumn("chunk", F.floor(F.col("chunk") / fanout))
        if chunks <= 1:
            break
        chunks, step = math.ceil(chunks / fanout), step + 1
    alone = (F.shiftrightunsigned(F.xxhash64("k2", "copy", F.lit(seed)), 11) / F.lit(2.0**53)) < F.col("x")
    closed.append(level.withColumns({"x": alone.cast("double"), "open": F.lit(False)}))
    decided = closed[0]
    for part in closed[1:]:
        decided = decided.unionByName(part)
    decided = decided.select("k1", "k2", "copy", F.col("x").cast("long").alias("extra"))
    copies = F.col("whole").cast("long") + F.coalesce("extra", F.lit(0).cast("long"))
    return (rows.join(decided, ["k1", "k2", "copy"], "left")
            .withColumn("copies", copies)
            .select("id", "k1", "k2", "copy", "source", "size", "source_size", "target", "copies",
                    (F.col("copies") * F.col("size")).alias("taken")))


def mixed_rows(docs: DataFrame, mix_of: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               source_col: str = "source") -> DataFrame:
    """The rows of ``docs`` that the mix takes, with a column ``copies`` (which
    replaces one of that name).

    A row gets copies that were decided for its own id, text and source.  Rows
    equal in these share them evenly, the rest of the division going to the
    first by a hash of the whole row, so reruns give the same rows; of rows
    equal in all columns it is of no consequence which one gets a copy.
    """
    out = [c for c in docs.columns if c != "copies"]
    at = ["__mix_k1", "__mix_k2"]
    got = mix_of.groupBy(F.col("k1").alias(at[0]), F.col("k2").alias(at[1])).agg(
        F.sum("copies").alias("__mix_all"), F.count(F.lit(1)).alias("__mix_rows")).where("__mix_all > 0")
    rows = docs.select(*[F.col(f"`{c}`") for c in out]).withColumns(
        {at[0]: F.xxhash64(id_col, source_col), at[1]: F.xxhash64(id_col, text_col, F.col(text_col).isNull())}).join(got, at)
    one = rows.where("__mix_rows = 1").withColumn("copies", F.col("__mix_all"))
    # equal rows are one row with a count, so a key of very many rows is few
    whole = F.struct(*[F.col(f"`{c}`") for c in out])
    kinds = (rows.where("__mix_rows > 1").withColumn("__mix_hash", F.xxhash64(F.to_json(whole)))
             .groupBy(*at, "__mix_all", "__mix_rows", "__mix_hash").agg(F.first(whole).alias("row"), F.count(F.lit(1)).alias("n")))
    before = F.coalesce(F.sum("n").over(Window.partitionBy(*at).orderBy("__mix_hash").rowsBetween(
        Window.unboundedPreceding, -1)), F.lit(0))
    each = F.floor(F.col("__mix_all") / F.col("__mix_rows"))
    more = F.greatest(F.lit(0), F.least(F.col("n"), F.col("__mix_all") % F.col("__mix_rows") - before)).cast("long")
    dealt = kinds.select("row", "n", each.alias("each"), more.alias("more")).select("row", F.inline(F.array(
        F.struct(F.col("more").alias("times"), (F.col("each") + 1).alias("copies")),
        F.struct((F.col("n") - F.col("more")).alias("times"), F.col("each").alias("copies")))))
    dealt = dealt.where("times > 0 AND copies > 0").select(
        "row", "copies", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))).alias("_"))
    return one.select(*[F.col(f"`{c}`") for c in out], "copies").union(dealt.select("row.*", "copies"))
