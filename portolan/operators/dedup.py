"""Deterministic removal of duplicate keys."""

from __future__ import annotations

import functools
import operator
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from portolan.functions import column
from portolan.operators.joins import fits_broadcast
from portolan.operators.profile import REPEATED, ROWS, key_counts, key_names
from portolan.sinks.staging import Staging

RANK = "__rank"
HEAVY, PART = "__heavy", "__part"

# A key with more rows than this is reduced in parts before it meets in one task.
HEAVY_ROWS = 100_000
PARTS = 64

# Rows of repeated keys count as few up to this share of the table.
RARE_SHARE = 0.1


def keep_one(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key under ``order``. Null is a key like any other.

    Rows are dealt out by key before they are ranked, so no task sorts a whole
    input split: the ranking of ``row_number() = 1`` then sorts only what one
    shuffle partition holds. A key with more than ``HEAVY_ROWS`` rows, found
    from the key columns alone, is first cut into ``PARTS`` parts by the task
    that read its rows; each part keeps its first row, and those few rows are
    ranked again, so such a key never meets whole in one place.
    """
    names = key_names(keys)
    same_key = functools.reduce(operator.and_, [column(k).eqNullSafe(F.col(n)) for k, n in zip(keys, names)])
    counted = df.groupBy(*[column(k).alias(n) for k, n in zip(keys, names)]).count()
    heavy = counted.where(F.col("count") > HEAVY_ROWS).select(*names, F.lit(True).alias(HEAVY))
    marked = df.join(F.broadcast(heavy), same_key, "left").drop(*names)
    # Light and heavy rows go to shuffles of their own, so each row is shuffled once and read once.
    by_key = [column(k) for k in keys]
    light = _first(marked.where(F.col(HEAVY).isNull()).repartition(*by_key), by_key, order)
    part = F.pmod(F.spark_partition_id(), F.lit(PARTS))
    dealt = marked.where(F.col(HEAVY)).withColumn(PART, part).repartition(*by_key, F.col(PART))
    parts = _first(_first(dealt, [*by_key, F.col(PART)], order), by_key, order)
    return light.drop(HEAVY).unionByName(parts.drop(HEAVY, PART))


def _first(df: DataFrame, keys: Sequence[Column], order: Sequence[Column]) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(RANK, F.row_number().over(window)).where(F.col(RANK) == 1).drop(RANK)


def _tie_break(df: DataFrame, keys: Sequence[str], order: Sequence[Column] | None) -> Sequence[Column]:
    if order:
        return order
    rest = [column(c) for c in df.columns if c not in keys]
    return rest or [column(k) for k in keys]


def dedup(df: DataFrame, keys: Sequence[str], order: Sequence[Column] | None = None) -> DataFrame:
    """One row per key, the same one on every run.

    The row with the smallest remaining columns wins unless ``order`` says
    otherwise.
    """
    return keep_one(df, keys, _tie_break(df, keys, order))


def dedup_rare(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column] | None = None,
    staging: Staging | None = None,
    rare: float = RARE_SHARE,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Same result as :func:`dedup`, for wide tables in which few keys repeat.

    First the repeated keys are found from the key columns alone. If their rows
    are at most the share ``rare`` of the table, and the keys few enough to
    broadcast, rows with any other key pass through without a shuffle and only
    the rows of repeated keys are ranked. Otherwise the whole table is ranked.
    ``df`` is read more than once, so it should be a stored table. ``counts`` is
    a stored :func:`key_counts` of the same rows and keys, if there is one; the
    keys are then not counted again.
    """
    if counts is None:
        staging = staging or Staging(df.sparkSession)
        counts = staging.write(key_counts(df, keys), "key-counts")
    names = key_names(keys)
    repeated = counts.where(F.col(REPEATED)).select(*names)
    concerned, rows = counts.agg(
        F.coalesce(F.sum(F.when(F.col(REPEATED), F.col(ROWS))), F.lit(0)), F.coalesce(F.sum(ROWS), F.lit(0))
    ).first()
    if concerned > rare * rows or not fits_broadcast(repeated):
        return dedup(df, keys, order)
    same_key = functools.reduce(
        operator.and_, [column(k).eqNullSafe(F.col(n)) for k, n in zip(keys, names)]
    )
    repeated = F.broadcast(repeated)
    single = df.join(repeated, same_key, "left_anti")
    several = df.join(repeated, same_key, "left_semi")
    return single.unionByName(dedup(several, keys, order))
