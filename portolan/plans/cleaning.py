"""Cleaning recipes for the three sources."""

from __future__ import annotations

import functools
import operator
from collections.abc import Collection, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portolan import schemas
from portolan.functions import column, sas_date, sas_date_string
from portolan.operators import dedup, dedup_rare, doubles_to_int, drop_columns, drop_missing, key_counts
from portolan.sinks import Staging


def clean_arrivals(
    df: DataFrame,
    drop: Sequence[str] = tuple(schemas.SPARSE_ARRIVALS),
    wide: Collection[str] = tuple(schemas.WIDE_ARRIVALS),
    zero_as_null: bool = False,
    as_string: bool = False,
    rare_duplicates: bool = False,
    staging: Staging | None = None,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Drop sparse columns, retype numbers, decode dates, keep one row per record.

    Records are told apart by the retyped key, the one that is stored; those
    whose key is lost in retyping share the null key and become one row.
    Dates are DATE columns with day 0 at the epoch; ``as_string`` gives ISO
    text and ``zero_as_null`` makes day 0 null. ``rare_duplicates`` avoids
    shuffling whole rows when few records repeat (see ``dedup_rare``); it needs
    ``df`` to be a stored table, and takes its :func:`arrival_counts` if they are stored.
    """
    df = retype_arrivals(drop_columns(df, drop), wide, zero_as_null, as_string)
    if rare_duplicates:
        return dedup_rare(df, schemas.ARRIVALS_KEY, staging=staging, counts=counts)
    return dedup(df, schemas.ARRIVALS_KEY)


def retype_arrivals(
    df: DataFrame,
    wide: Collection[str] = tuple(schemas.WIDE_ARRIVALS),
    zero_as_null: bool = False,
    as_string: bool = False,
) -> DataFrame:
    """Doubles to integers, day numbers to dates; a value outside its new type becomes null."""
    decode = sas_date_string if as_string else sas_date
    dates = {c: decode(F.col(c), zero_as_null) for c in ("arrdate", "depdate")}
    # Dates are decoded from the doubles: a number too large for any date must not wrap.
    typed = doubles_to_int(df.withColumns(dates), [c for c in wide if c in df.columns])
    return typed.select(*[column(c) for c in df.columns])


NULLED = ("nulled_keys", "nulled_values")


def arrival_counts(df: DataFrame, drop: Sequence[str] = tuple(schemas.SPARSE_ARRIVALS)) -> DataFrame:
    """:func:`key_counts` of the retyped records, with what retyping turned into null.

    One pass over the numbers of the arrivals; it feeds the removal of
    duplicates, the loss report and so the checks. ``nulled_keys`` and
    ``nulled_values`` are record keys and values of any column, keys included,
    that were there before and are null after.
    """
    df = drop_columns(df, drop)
    names = [f.name for f in df.schema if f.dataType.typeName() == "double"]
    after = retype_arrivals(df.select("*", F.struct(*names).alias("__before")))
    was = {c: F.col("__before").getField(c) for c in names}
    lost = {c: (was[c].isNotNull() & ~F.isnan(was[c]) & column(c).isNull()).cast("long") for c in names}
    total = functools.reduce(operator.add, lost.values(), F.lit(0))
    sums = dict(zip(NULLED, (lost.get(schemas.ARRIVALS_KEY[0], F.lit(0)), total)))
    return key_counts(after, schemas.ARRIVALS_KEY, sums=sums)


def clean_temperature(df: DataFrame, date_as_string: bool = True) -> DataFrame:
    """Drop readings without a value, keep one per day and city, render the day as text."""
    df = drop_missing(df, schemas.REQUIRED_TEMPERATURE)
    df = dedup(df, schemas.TEMPERATURE_KEY)
    return df.withColumn("dt", F.col("dt").cast("string")) if date_as_string else df


def clean_demographics(df: DataFrame) -> DataFrame:
    """Drop rows with a missing figure, keep one per city and race."""
    return dedup(drop_missing(df, schemas.REQUIRED_DEMOGRAPHICS), schemas.DEMOGRAPHICS_KEY)
