"""Profiles of missing values and of rows lost in cleaning.

Each profile is one aggregate over the table. Counts are taken by aggregates
rather than by accumulators or observed metrics, because a task that is run
again after the loss of an executor would be counted twice by those.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from portolan.functions import column, is_missing

REPEATED, ROWS, MISSING, KEPT = "__repeated", "__rows", "__missing", "__kept"


def null_profile(df: DataFrame, rows: str | None = None) -> DataFrame:
    """One row: the number of null or NaN values of every column.

    With ``rows`` the number of rows is added under that name.
    """
    counts = [F.count_if(is_missing(f.name, f.dataType)).alias(f.name) for f in df.schema]
    if rows:
        counts.append(F.count(F.lit(1)).alias(rows))
    return df.agg(*counts)


def null_percent(df: DataFrame, only_missing: bool = True) -> DataFrame:
    """One row per column: ``(column_name, null_values, pct_missing)``.

    ``only_missing`` leaves out the columns without missing values.
    """
    profile = null_profile(df, rows="__rows")
    long = profile.unpivot("__rows", [column(c) for c in df.columns], "column_name", "null_values")
    share = F.lit(100.0) * F.col("null_values") / F.nullif(F.col("__rows"), F.lit(0))
    long = long.select("column_name", "null_values", share.alias("pct_missing"))
    return long.where(F.col("pct_missing") > 0) if only_missing else long


def dropna_loss(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """``(before, after, dropped)`` for dropping rows with a missing value in ``subset``."""
    types = {f.name: f.dataType for f in df.schema}
    missing = functools.reduce(operator.or_, [is_missing(c, types[c]) for c in subset])
    before, dropped = F.count(F.lit(1)), F.count_if(missing)
    return df.agg(
        before.alias("before"), (before - dropped).alias("after"), dropped.alias("dropped")
    )


def dedup_loss(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``(before, after, dropped)`` for keeping one row per key.

    Rows are counted per key before the shuffle; only keys and counts move.
    """
    per_key = df.groupBy(*[column(k) for k in keys]).agg(F.count(F.lit(1)).alias("__n"))
    before, after = F.coalesce(F.sum("__n"), F.lit(0)), F.count(F.lit(1))
    return per_key.agg(
        before.alias("before"), after.alias("after"), (before - after).alias("dropped")
    )


def cleaning_loss(df: DataFrame, subset: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Both steps in one pass: ``(before, dropped_missing, dropped_duplicates, after)``.

    Rows with a missing value in ``subset`` go first, then all but one row per
    key.
    """
    per_key = _per_key(df, subset, [column(k).alias(n) for k, n in zip(keys, key_names(keys))], {})
    return _losses(per_key.withColumn(KEPT, (F.col(ROWS) > F.col(MISSING)).cast("bigint")), [])


def key_names(keys: Sequence[str]) -> list[str]:
    """The names of the key columns of :func:`key_counts`."""
    return [f"__key_{i}" for i in range(len(keys))]


def key_counts(
    df: DataFrame, keys: Sequence[str], subset: Sequence[str] = (), sums: Mapping[str, Column] | None = None
) -> DataFrame:
    """What removal of duplicates and its loss report need to know, from one pass.

    A row per key that occurs more than once, and one row for all other keys
    together, whose keys are null and whose ``REPEATED`` is false: so the table
    is as small as the repeated keys are few. Columns are the keys under
    :func:`key_names`, the number of rows, of rows with a missing value in
    ``subset`` and of keys with a row without one, and the sum of each column in ``sums``.

    Rows are added up per key before they are shuffled, and the keys that occur
    once before they are shuffled again; so neither meets in one task.
    """
    sums = dict(sums or {})
    names = key_names(keys)
    per_key = _per_key(df, subset, [column(k).alias(n) for k, n in zip(keys, names)], sums)
    several = F.col(ROWS) > 1
    shown = [F.when(several, F.col(n)).alias(n) for n in names]
    totals = [F.sum(c).alias(c) for c in (ROWS, MISSING)]
    totals.append(F.count_if(F.col(ROWS) > F.col(MISSING)).alias(KEPT))
    return per_key.groupBy(several.alias(REPEATED), *shown).agg(*totals, *[F.sum(c).alias(c) for c in sums])


def counted_loss(counts: DataFrame, sums: Sequence[str] = ()) -> DataFrame:
    """:func:`cleaning_loss` from :func:`key_counts`, with the columns that were summed there."""
    return _losses(counts, sums)


def _per_key(df: DataFrame, subset: Sequence[str], keys: Sequence[Column], sums: Mapping[str, Column]) -> DataFrame:
    types = {f.name: f.dataType for f in df.schema}
    missing = functools.reduce(
        operator.or_, [is_missing(c, types[c]) for c in subset], F.lit(False)
    )
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias(ROWS),
        F.count_if(missing).alias(MISSING),
        *[F.sum(value).alias(name) for name, value in sums.items()],
    )


def _losses(counts: DataFrame, sums: Sequence[str]) -> DataFrame:
    before, lost, after, *others = [F.coalesce(F.sum(c), F.lit(0)) for c in (ROWS, MISSING, KEPT, *sums)]
    return counts.agg(
        before.alias("before"),
        lost.alias("dropped_missing"),
        (before - lost - after).alias("dropped_duplicates"),
        after.alias("after"),
        *[value.alias(name) for name, value in zip(sums, others)],
    )
