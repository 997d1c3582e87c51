"""Sums of doubles that are the same in any order of the rows.

A sum of doubles depends on the order of its terms, hence on how rows are
spread over partitions. Here every value is taken apart into whole numbers in
units that depend on its size only; these are added without any rounding, and
put together in a fixed order at the end. Built-in functions only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from portolan.functions import column

# Values of 10 binary orders of magnitude share a unit. With 53 bits of a value and two spare ones for a rounded
# logarithm they make numbers below 2^66, cut into three parts of 22 bits: 2^41 rows of a group can be added in 64 bits.
ORDERS, SPARE, PART_BITS = 10, 54, 22
PARTS = ["__high", "__middle", "__low"]


def _power(exponent: Column) -> Column:
    return F.pow(F.lit(2.0), exponent)


def _scaled(value: Column, exponent: Column) -> Column:
    """``value * 2^exponent``, in two steps, of which none overflows where the result does not."""
    half = F.floor(exponent / 2)
    return value * _power(half) * _power(exponent - half)


def exact_average(df: DataFrame, keys: Sequence[str], value: Column, name: str, weight: Column | None = None) -> DataFrame:
    """The mean of ``value`` per group of ``keys``, with the same bits whatever the order of the rows.

    Nulls do not count; without a value the mean is null. NaN, or infinities
    of both signs, give NaN. ``weight`` is a whole number of times each value
    counts; a null one counts as no value. A product of value and weight is rounded once, the same way in every
    run. Rows are first added per group and size of value, which Spark does
    before it shuffles; a group has as many such rows as its values have orders of magnitude by tens.
    """
    given = value.cast("double")
    weight = F.lit(1).cast("bigint") if weight is None else weight.cast("bigint")
    x = F.when(weight.isNotNull(), given * weight)
    finite = x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    size = F.floor(F.log2(F.abs(x)) / ORDERS).cast("int")
    inner = df.select(
        *[column(k) for k in keys],
        x.alias("__x"),
        F.when(x.isNotNull(), weight).alias("__weight"),
        F.when(finite & (x != 0), size).alias("__size"),
    )
    # A whole number below 2^66 in the unit of its size; division and remainder by powers of two are exact.
    whole = _scaled(F.col("__x"), F.lit(SPARE) - F.col("__size") * ORDERS)
    one = float(1 << PART_BITS)
    high = (whole / (one * one)).cast("bigint")  # toward zero, so no part is larger than the whole
    rest = whole - high.cast("double") * (one * one)
    middle = (rest / one).cast("bigint")
    low = rest - middle.cast("double") * one
    measured = F.col("__size").isNotNull()
    parts = {"__high": high, "__middle": middle, "__low": low}
    inner = inner.withColumns({n: F.when(measured, p).cast("bigint") for n, p in parts.items()})
    sums = inner.groupBy(*[column(k) for k in keys], "__size").agg(
        *[F.sum(n).alias(n) for n in PARTS],
        F.sum("__weight").alias("__n"),
        F.max(F.isnan("__x") | (F.col("__x") == float("inf"))).alias("__up"),
        F.max(F.isnan("__x") | (F.col("__x") == float("-inf"))).alias("__down"),
    )
    terms = F.array_sort(F.collect_list(F.when(measured, F.struct("__size", *PARTS))))
    groups = sums.groupBy(*[column(k) for k in keys]).agg(
        terms.alias("__terms"),
        F.sum("__n").alias("__n"),
        F.coalesce(F.max("__up"), F.lit(False)).alias("__up"),
        F.coalesce(F.max("__down"), F.lit(False)).alias("__down"),
    )
    total = _total(F.col("__terms"))
    infinite = F.when(F.col("__up") & F.col("__down"), float("nan")).when(F.col("__up"), float("inf")).when(F.col("__down"), float("-inf"))
    mean = F.coalesce(infinite, total) / F.nullif(F.col("__n"), F.lit(0)).cast("double")
    return groups.select(*[column(k) for k in keys], mean.alias(name))


def _total(terms: Column) -> Column:
    """The sum of all parts, smallest sizes first, with what rounding loses carried along."""
    half = float(1 << 32)

    def pieces(term: Column) -> Column:
        # Each sum of parts is below 2^63 and cut in two, so that doubles hold both halves.
        out = []
        for place, name in enumerate(reversed(PARTS)):
            upper = F.when(term[name] < 0, -F.shiftright(-term[name], 32)).otherwise(F.shiftright(term[name], 32))
            lower = term[name] - F.shiftleft(upper, 32)
            unit = term["__size"] * ORDERS - SPARE + place * PART_BITS
            out += [_scaled(lower.cast("double"), unit), _scaled(upper.cast("double") * half, unit)]
        return F.array(*out)

    start = F.struct(F.lit(0.0).alias("sum"), F.lit(0.0).alias("lost"))

    def add(state: Column, x: Column) -> Column:
        total = state["sum"] + x
        lost = F.when(F.abs(state["sum"]) >= F.abs(x), (state["sum"] - total) + x).otherwise((x - total) + state["sum"])
        return F.struct(total.alias("sum"), (state["lost"] + lost).alias("lost"))

    def finish(state: Column) -> Column:
        # A sum beyond all doubles is infinite; nothing can be carried there.
        return F.when(F.abs(state["sum"]) < float("inf"), state["sum"] + state["lost"]).otherwise(state["sum"])

    return F.aggregate(F.flatten(F.transform(terms, pieces)), start, add, finish)
