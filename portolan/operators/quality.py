"""Data-quality checks. Each gives rows with a status, PASS or FAIL."""

from __future__ import annotations

import functools
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from portolan.functions import column
from portolan.operators.groups import row_counts


def _status(passed: Column) -> Column:
    return F.when(passed, "PASS").otherwise("FAIL").alias("status")


def check_not_empty(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``(table_name, row_count, status)``; an empty table fails."""
    return row_counts(tables).select("*", _status(F.col("row_count") > 0))


def check_unique(tables: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """``(table_name, key_columns, duplicate_groups, excess_rows, status)``.

    ``tables`` maps a name to a frame and its key columns. Rows are counted per
    key before the shuffle. Nulls count as equal to each other.
    """
    results = []
    for name, (df, keys) in tables.items():
        per_key = df.groupBy(*[column(k) for k in keys]).agg(F.count(F.lit(1)).alias("__n"))
        totals = per_key.agg(
            F.count_if(F.col("__n") > 1).alias("duplicate_groups"),
            F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).alias("excess_rows"),
        )
        results.append(
            totals.select(
                F.lit(name).alias("table_name"),
                F.lit(",".join(keys)).alias("key_columns"),
                "duplicate_groups",
                "excess_rows",
                _status(F.col("duplicate_groups") == 0),
            )
        )
    return functools.reduce(DataFrame.unionByName, results)


def check_not_null(tables: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """``(table_name, column_name, null_values, status)``, one row per checked column.

    All columns of a table are counted in one aggregate.
    """
    results = []
    for name, (df, columns) in tables.items():
        counts = df.agg(*[F.count_if(column(c).isNull()).alias(c) for c in columns])
        long = counts.unpivot([], [column(c) for c in columns], "column_name", "null_values")
        results.append(
            long.select(
                F.lit(name).alias("table_name"),
                "column_name",
                "null_values",
                _status(F.col("null_values") == 0),
            )
        )
    return functools.reduce(DataFrame.unionByName, results)


def check_references(links: Mapping[tuple[str, str], tuple[DataFrame, DataFrame, str]]) -> DataFrame:
    """``(table_name, column_name, orphans, status)``: rows whose key its dimension lacks.

    ``links`` maps a table and its column to the table, the dimension and the
    dimension's column. Rows are counted per key first, so only keys meet the
    dimension. A null key refers to nothing and is no orphan.
    """
    results = []
    for (name, key), (df, dim, other) in links.items():
        keys = df.where(column(key).isNotNull()).groupBy(column(key).alias("__key")).agg(F.count(F.lit(1)).alias("__n"))
        known = dim.select(column(other).alias("__known"))
        lost = keys.join(known, F.col("__key") == F.col("__known"), "left_anti")
        results.append(
            lost.agg(F.coalesce(F.sum("__n"), F.lit(0)).alias("orphans")).select(
                F.lit(name).alias("table_name"),
                F.lit(key).alias("column_name"),
                "orphans",
                _status(F.col("orphans") == 0),
            )
        )
    return functools.reduce(DataFrame.unionByName, results)


def raise_on_failure(checks: DataFrame | Sequence[Row]) -> DataFrame | Sequence[Row]:
    """Raise ``ValueError`` naming the failed checks; else give ``checks`` back.

    Checks that were collected are taken as they are. Of a frame only failed
    rows reach the driver, at most one per table and checked column.
    """
    if isinstance(checks, DataFrame):
        failed = checks.where(F.col("status") == "FAIL").collect()
    else:
        failed = [r for r in checks if r.status == "FAIL"]
    if failed:
        raise ValueError("data quality check failed: " + "; ".join(str(r.asDict()) for r in failed))
    return checks
