"""Left lookup of a fact table in a dimension."""

from __future__ import annotations

import functools
import operator
import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from portolan.functions import column
from portolan.sinks.staging import Staging

SIZE_UNITS = {"": 1, "b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20, "g": 1 << 30, "gb": 1 << 30}
ROW_OVERHEAD = 16
PIECES, PIECE = "__pieces", "__piece"


def broadcast_limit(spark: SparkSession) -> int:
    """The session's ``spark.sql.autoBroadcastJoinThreshold`` in bytes; below 0 means never."""
    text = spark.conf.get("spark.sql.autoBroadcastJoinThreshold").strip().lower()
    number, unit = re.fullmatch(r"(-?\d+)\s*([a-z]*)", text).groups()
    return int(number) * SIZE_UNITS[unit]


def _row_bytes(df: DataFrame) -> Column:
    """Size of a row in memory, from its real text lengths."""
    fixed, texts = ROW_OVERHEAD, []
    for f in df.schema:
        fixed += 8
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            texts.append(F.coalesce(F.octet_length(column(f.name)), F.lit(0)))
        elif not isinstance(f.dataType, (T.NumericType, T.BooleanType, T.DatetimeType)):
            texts.append(F.coalesce(F.octet_length(F.to_json(F.struct(column(f.name)))), F.lit(0)))
    return functools.reduce(operator.add, texts, F.lit(fixed)).cast("long")


def measured_bytes(df: DataFrame) -> int:
    """Size of ``df`` in memory; one aggregate."""
    return int(df.agg(F.coalesce(F.sum(_row_bytes(df)), F.lit(0))).first()[0])


def _measured_dimension(dim: DataFrame, keys: list[str], null_safe: bool) -> int:
    """Size of a dimension in memory; the same aggregate makes sure that no key repeats.

    A key with a null finds nothing unless ``null_safe``, so it may repeat.
    """
    matched = F.lit(True) if null_safe else functools.reduce(operator.and_, [column(k).isNotNull() for k in keys])
    per_key = dim.groupBy(*[column(k) for k in keys]).agg(
        F.count(F.lit(1)).alias("__n"), F.sum(_row_bytes(dim)).alias("__bytes")
    )
    size, repeated = per_key.agg(
        F.coalesce(F.sum("__bytes"), F.lit(0)), F.count_if((F.col("__n") > 1) & matched)
    ).first()
    if repeated:
        raise ValueError(f"{repeated} keys of the dimension occur more than once; a lookup needs unique keys")
    return int(size)


def _hashable(dtype: T.DataType) -> bool:
    """Whether Spark hashes values of a type: not those with a map or variant inside."""
    if isinstance(dtype, T.StructType):
        return all(_hashable(f.dataType) for f in dtype)
    if isinstance(dtype, T.ArrayType):
        return _hashable(dtype.elementType)
    return not isinstance(dtype, (T.MapType, T.VariantType))


def _row_hash(df: DataFrame) -> Column:
    """A hash of a row's hashable columns; without any, of its text form."""
    names = [f.name for f in df.schema if _hashable(f.dataType)]
    return F.xxhash64(*[column(c) for c in names]) if names else F.xxhash64(F.to_json(F.struct("*")))


def fits_broadcast(df: DataFrame, limit: int | None = None) -> bool:
    """Whether the measured size of ``df`` is within the broadcast limit."""
    limit = broadcast_limit(df.sparkSession) if limit is None else limit
    return limit > 0 and measured_bytes(df) <= limit


def _match(left: list[str], right: list[str], null_safe: bool) -> Column:
    pairs = [
        column(a).eqNullSafe(column(b)) if null_safe else column(a) == column(b) for a, b in zip(left, right)
    ]
    return functools.reduce(operator.and_, pairs)


def lookup_join(
    fact: DataFrame,
    dim: DataFrame,
    on: Mapping[str, str],
    null_safe: bool = False,
    limit: int | None = None,
    staging: Staging | None = None,
) -> DataFrame:
    """Left join that keeps every fact row and adds the columns of ``dim``.

    ``on`` maps fact columns to the key columns of ``dim``; the latter are not
    part of the result. They must be unique there, and no other column of
    ``dim`` may have the name of a fact column: both raise ``ValueError``. A
    null key finds nothing unless ``null_safe``.

    A dimension whose measured size is within the broadcast limit is broadcast:
    the fact table is not shuffled and a frequent key does no harm. A larger
    one is joined by shuffle, with frequent keys cut into pieces; their list
    goes to ``staging``, which the caller clears, or to a folder of its own.
    """
    taken = {c.lower() for c in fact.columns}
    clash = [c for c in dim.columns if c not in on.values() and c.lower() in taken]
    if clash:
        raise ValueError(f"fact and dimension both have a column {', '.join(clash)}")
    names = {b: f"__dim_{i}" for i, b in enumerate(on.values())}
    dim = dim.withColumnsRenamed(names)
    left, right = list(on), list(names.values())
    size = _measured_dimension(dim, right, null_safe)
    limit = broadcast_limit(fact.sparkSession) if limit is None else limit
    if 0 < limit and size <= limit:
        joined = fact.join(F.broadcast(dim), _match(left, right, null_safe), "left")
    else:
        joined = _join_in_pieces(fact, dim, left, right, null_safe, staging or Staging(fact.sparkSession))
    return joined.drop(*right)


def _join_in_pieces(
    fact: DataFrame, dim: DataFrame, left: list[str], right: list[str], null_safe: bool, staging: Staging
) -> DataFrame:
    """Shuffle join in which no key, null included, is bound to a single task.

    A key is frequent when it holds more than one shuffle partition's fair
    share of the fact rows. There are at most as many such keys as shuffle
    partitions, hence they can be broadcast. Their fact rows are spread by a
    hash of the row over as many pieces as they have shares, and their
    dimension row is repeated once per piece. The hash, unlike a random number
    or a row counter, is the same when a lost task is run again. Exact copies
    of one fact row share a piece; adaptive execution splits those by size.

    The dimension has been measured as too large, so the hint keeps Spark from
    broadcasting it after all on account of its smaller, compressed file size.
    ``fact`` is read twice, for its keys and for the join, so it should be a
    stored table.
    """
    spark = fact.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    hot_names = [f"__hot_{i}" for i in range(len(left))]
    counted = fact.groupBy(*[column(c).alias(h) for c, h in zip(left, hot_names)]).agg(F.count(F.lit(1)).alias(PIECES))
    # Staged: the total, the shares and both sides of the join come from this one pass over the keys.
    counted = staging.write(counted, "key-counts")
    share = max(1, (counted.agg(F.sum(PIECES)).first()[0] or 0) // partitions)
    hot = counted.where(F.col(PIECES) > share).withColumn(PIECES, F.ceil(F.col(PIECES) / F.lit(share)).cast("int"))
    if hot.isEmpty():
        return fact.join(dim.hint("merge"), _match(left, right, null_safe), "left")
    pieces = F.coalesce(F.col(PIECES), F.lit(1))

    spread = fact.withColumn("__hash", _row_hash(fact)).join(F.broadcast(hot), _match(left, hot_names, True), "left").withColumn(
        "__fact_piece", F.pmod(F.col("__hash"), pieces)
    )
    repeated = dim.join(F.broadcast(hot), _match(right, hot_names, True), "left").withColumn(
        PIECE, F.explode(F.sequence(F.lit(0), pieces - 1))
    )
    spread = spread.drop(PIECES, "__hash", *hot_names)
    repeated = repeated.drop(PIECES, *hot_names)
    same = _match(left, right, null_safe) & (F.col("__fact_piece") == F.col(PIECE))
    return spread.join(repeated.hint("merge"), same, "left").drop("__fact_piece", PIECE)
