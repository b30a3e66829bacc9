"""Sums of floats that do not depend on the order of their rows.

Every finite double is a sum of at most five digits to the base 2^24, each an
integer at a fixed power (its bin).  Integers add up exactly in any order, so
digits are summed per (group, bin) with map-side combine, and each group's
few bins are carried over and rounded once, to the nearest double.  The result
is the exact sum, rounded, however the rows are partitioned; no magnitude
overflows on the way.  Plain expressions, no UDF.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daycut.operators.rows import computed

BITS = 24
BASE = 1 << BITS
#: Digits that a double can need, with one to spare for the estimated first bin.
DIGITS = 5
#: Doubles below this are scaled up first: their powers are no doubles.
_TINY, _LIFT = 2.0 ** -900, 10

#: Aggregates that can follow the sum, by what adds up their parts.
_AGAIN = {"count": F.sum, "sum": F.sum, "min": F.min, "max": F.max}


def _power(exponent: Column) -> Column:
    return F.pow(F.lit(2.0), exponent.cast("double"))


def _pieces(value: Column) -> Column:
    """array<struct<bin, digit>> of a value; null, zero, infinities and NaN
    have one piece without a bin."""
    size = F.abs(value)
    tiny = size < F.lit(_TINY)
    size = F.when(tiny, size * F.lit(2.0 ** (BITS * _LIFT))).otherwise(size)
    first = F.floor(F.log2(size) / F.lit(float(BITS))).cast("int")
    scaled = size * _power(-first * F.lit(BITS))
    sign = F.when(value < 0, F.lit(-1)).otherwise(F.lit(1)).cast("long")
    lift = F.when(tiny, F.lit(_LIFT)).otherwise(F.lit(0))
    digits = [F.floor(scaled)] + [F.floor((scaled * F.lit(2.0 ** (BITS * i))) % F.lit(float(BASE))) for i in range(1, DIGITS)]
    parts = F.array(*[F.struct((first - lift - F.lit(i)).alias("bin"), (sign * d.cast("long")).alias("digit"))
                      for i, d in enumerate(digits)])
    nothing = F.array(F.struct(F.lit(None).cast("int").alias("bin"), F.lit(0).cast("long").alias("digit")))
    plain = value.isNotNull() & ~F.isnan(value) & (value != 0) & (F.abs(value) != F.lit(float("inf")))
    return F.when(plain, parts).otherwise(nothing)


def _carried(digits: Column) -> Column:
    """Digits 0 … BASE-1 from the lowest bin up, and what is carried beyond:
    0, or -1 if the total is negative."""
    start = F.struct(F.lit(0).cast("long").alias("carry"), F.array().cast("array<long>").alias("digits"))

    def step(acc: Column, x: Column) -> Column:
        total = acc["carry"] + x
        return F.struct(F.shiftright(total, BITS).alias("carry"),
                        F.concat(acc["digits"], F.array(F.pmod(total, F.lit(BASE).cast("long")))).alias("digits"))

    return F.aggregate(digits, start, step)


def _rounded(groups: DataFrame, name: str) -> DataFrame:
    """``groups`` with ``__bins`` (map of bin → sum) replaced by ``name``, the
    double nearest to their sum; null without bins.  Each step is evaluated
    once, so the expressions stay small."""
    keep = [F.col(c) for c in groups.columns if c != "__bins"]
    bins, c = F.col("__bins"), F.col
    low = F.array_min(F.map_keys(bins))
    dense = F.transform(F.sequence(low, F.array_max(F.map_keys(bins)) + F.lit(3)),
                        lambda b: F.coalesce(F.try_element_at(bins, b), F.lit(0).cast("long")))
    some = F.size(bins) > 0
    step = computed(groups, [*keep, F.when(some, low).alias("__low"), F.when(some, dense).alias("__dense")])
    step = computed(step, [*keep, c("__low"), c("__dense"), _carried(c("__dense")).alias("__up")])
    negative = c("__up.carry") < 0
    step = computed(step, [*keep, c("__low"), negative.alias("__minus"), F.when(
        negative, _carried(F.transform("__dense", lambda d: -d))["digits"]).otherwise(c("__up.digits")).alias("__digits")])
    step = computed(step, [*keep, c("__low"), c("__minus"), c("__digits"),
                           F.array_max(F.transform("__digits", lambda d, i: F.when(d != 0, i))).alias("__top")])
    digits, top = c("__digits"), c("__top")
    # four digits hold at least 73 bits; what lies below them only breaks ties
    value = F.lit(0).cast("decimal(38,0)")
    for k in range(4):
        at = F.when(top >= k, F.get(digits, top - F.lit(k)))
        value = value + F.coalesce(at, F.lit(0).cast("long")).cast("decimal(8,0)") * F.lit(f"{1 << BITS * (3 - k)}").cast("decimal(22,0)")
    below = F.exists(F.slice(digits, F.lit(1), F.greatest(top - F.lit(3), F.lit(0))), lambda d: d != 0)
    odd = value.cast("decimal(30,0)") * F.lit(2).cast("decimal(1,0)") + F.when(below, 1).otherwise(0).cast("decimal(1,0)")
    step = computed(step, [*keep, c("__low"), c("__minus"), top.alias("__top"), odd.cast("double").alias("__size"),
                           ((c("__low") + top - F.lit(3)) * F.lit(BITS) - F.lit(1)).alias("__exp")])
    half = F.floor(c("__exp") / F.lit(2)).cast("int")
    size = c("__size") * _power(half) * _power(c("__exp") - half)
    return step.select(*keep, F.when(c("__low").isNull(), F.lit(None)).when(c("__top").isNull(), F.lit(0.0))
                       .when(c("__minus"), -size).otherwise(size).alias(name))


def exact_sum_by(rows: DataFrame, keys: list[str], value: Column, name: str,
                 others: dict[str, tuple[str, Column]] | None = None) -> DataFrame:
    """``GROUP BY keys`` with the exact sum of ``value`` as ``name``.

    ``others``: name → (count, sum, min or max; column) computed with it.
    Nulls are skipped; a group of nulls alone has a null sum, one with NaN or
    infinities what adding these gives.
    """
    others = others or {}
    taken = rows.select(*keys, value.cast("double").alias("__value"), *[c.alias(f"__{n}") for n, (_, c) in others.items()])
    pieces = taken.select(*keys, "__value", *[f"__{n}" for n in others], F.posexplode(_pieces(F.col("__value"))).alias("__at", "__p"))
    pieces = pieces.where("__at = 0 OR __p.digit <> 0")
    once = F.col("__at") == 0                               # a row's other values count with its first piece
    odd = F.isnan("__value") | (F.abs("__value") == F.lit(float("inf")))
    first: dict[str, Callable] = {n: getattr(F, how) for n, (how, _) in others.items()}
    by_bin = pieces.groupBy(*keys, F.col("__p.bin").alias("__bin")).agg(
        F.sum("__p.digit").alias("__sum"), F.sum(F.when(once & odd, F.col("__value"))).alias("__odd"),
        F.count(F.when(once, F.col("__value"))).alias("__n"),
        *[f(F.when(once, F.col(f"__{n}"))).alias(n) for n, f in first.items()])
    bins = F.map_from_entries(F.collect_list(F.when(F.col("__bin").isNotNull(), F.struct("__bin", "__sum"))))
    out = by_bin.groupBy(*keys).agg(bins.alias("__bins"), F.sum("__odd").alias("__odd"), F.sum("__n").alias("__n"),
                                    *[_AGAIN[how](n).alias(n) for n, (how, _) in others.items()])
    out = _rounded(out, "__total")
    total = F.when(F.col("__n") > 0, F.coalesce("__odd", "__total", F.lit(0.0)))
    return out.select(*keys, total.alias(name), *others)
