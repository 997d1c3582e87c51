"""Surrogate keys: dense, starting at 0, in the order of stated columns.

Nulls come last, but in a merge with a stored dimension, where new values follow
the old ones. The keys depend on the rows only, never on how they are
spread over partitions. The ordering columns must identify a row.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from portolan.functions import column
from portolan.sinks.staging import Staging

# A table of up to this many rows is numbered by one task.
SMALL_ROWS = 1_000_000
PART, POSITION, OFFSET = "__part", "__position", "__offset"
POSITION_BITS = 33  # monotonically_increasing_id keeps the row's place in its low 33 bits


def dense_key_small(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """Number the rows in one task; only for tables with a bound on their rows."""
    window = Window.orderBy(*[column(c).asc_nulls_last() for c in order])
    return df.withColumn(name, F.row_number().over(window).cast("bigint") - 1)


def dense_key_by_range(
    df: DataFrame, order: Sequence[str], name: str, staging: Staging | None = None
) -> DataFrame:
    """Number the rows in parallel.

    The table is split by ranges of the whole ordering key and sorted within
    each range, so a frequent leading value is split too. Each row's place in
    its range is stored with it; the number of rows in earlier ranges, one
    value per range, is then added. The sorted table is staged because the
    range limits come from a sample and might differ in a second evaluation.
    """
    staging = staging or Staging(df.sparkSession)
    by = [column(c).asc_nulls_last() for c in order]
    placed = df.repartitionByRange(*by).sortWithinPartitions(*by)
    placed = placed.withColumns(
        {
            PART: F.spark_partition_id(),
            POSITION: F.monotonically_increasing_id().bitwiseAND(F.lit((1 << POSITION_BITS) - 1)),
        }
    )
    placed = staging.write(placed, "ranges")
    earlier = Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(PART)
        .agg(F.count(F.lit(1)).alias("n"))
        .select(PART, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias(OFFSET))
    )
    # One row per range: bounded by the number of shuffle partitions.
    numbered = placed.join(F.broadcast(offsets), PART)
    return numbered.withColumn(name, F.col(OFFSET) + F.col(POSITION)).drop(PART, POSITION, OFFSET)


def add_dense_key(
    df: DataFrame,
    order: Sequence[str],
    name: str,
    staging: Staging | None = None,
    small_rows: int = SMALL_ROWS,
) -> DataFrame:
    """Number the rows, in one task if they are few, else by ranges.

    ``df`` should be a stored table: its rows are counted first.
    """
    if df.count() <= small_rows:
        return dense_key_small(df, order, name)
    return dense_key_by_range(df, order, name, staging)


def merge_dimension(
    new: DataFrame,
    stored: DataFrame,
    natural: Sequence[str],
    key: str,
    staging: Staging | None = None,
    small_rows: int = SMALL_ROWS,
) -> DataFrame:
    """A dimension in which every value keeps the key it has in ``stored``.

    ``natural`` names the columns that identify a row on both sides; null is a
    value like any other. Rows of ``new`` that ``stored`` knows take its key
    and their own, newer attributes. Unknown ones are numbered on from the
    largest key, in the order of ``natural``. Rows that only ``stored`` has
    stay as they are, because facts of earlier runs point to them. ``new`` has
    no column ``key``; columns that ``stored`` lacks are null in its own rows.

    Natural keys are unique on both sides, else ``ValueError``; so each meets
    at most one row and no join is skewed.
    """
    staging = staging or Staging(new.sparkSession)
    names = [f"__natural_{i}" for i in range(len(natural))]
    known = stored.select(*[column(c).alias(n) for c, n in zip(natural, names)], column(key).alias(key))
    for side, df, by in (("new", new, natural), ("stored", known, names)):
        if not df.groupBy(*[column(c) for c in by]).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").isEmpty():
            raise ValueError(f"the {side} rows repeat a value of {', '.join(natural)}")

    def same(left: Sequence[str], right: Sequence[str]) -> Column:
        return functools.reduce(operator.and_, [column(a).eqNullSafe(column(b)) for a, b in zip(left, right)])

    met = staging.write(new.join(known, same(natural, names), "left").drop(*names), "met")
    last = stored.agg(F.max(column(key))).first()[0]
    fresh = add_dense_key(met.where(column(key).isNull()).drop(key), natural, key, staging, small_rows)
    fresh = fresh.withColumn(key, column(key) + F.lit(0 if last is None else last + 1).cast("bigint"))
    values = new.select(*[column(c).alias(n) for c, n in zip(natural, names)])
    gone = stored.join(values, same(natural, names), "left_anti")
    return met.where(column(key).isNotNull()).unionByName(fresh).unionByName(gone, allowMissingColumns=True)
