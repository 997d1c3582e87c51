"""Counts, averages, distinct values and previews."""

from __future__ import annotations

import functools
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from portolan.functions import column
from portolan.operators.exact import exact_average


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Number of rows of each table, as one frame ``(table_name, row_count)``."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return functools.reduce(DataFrame.unionByName, counts)


def average_by(df: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """Average of ``value`` per ``key``, called ``name``; the same bits however the rows are spread."""
    return exact_average(df, [key], column(value), name)


def distinct_values(df: DataFrame, name: str) -> DataFrame:
    """Distinct values of one column; null counts as a value."""
    return df.select(column(name)).distinct()


def preview(df: DataFrame, order: Sequence[str | Column], n: int = 5) -> DataFrame:
    """The first ``n`` rows in a stated order, so that a preview repeats.

    Spark runs this as a top-n: each task keeps ``n`` rows.
    """
    return df.orderBy(*order).limit(n)
