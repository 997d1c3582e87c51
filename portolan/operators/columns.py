"""Projections: choose, drop, rename and retype columns."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from portolan.functions import column, truncate_to_int
from portolan.operators.profile import null_profile

ROWS = "__rows"


def _require(df: DataFrame, names: Collection[str]) -> None:
    absent = [n for n in names if n not in df.columns]
    if absent:
        raise ValueError(f"no such column: {', '.join(absent)}; have {', '.join(df.columns)}")


def select_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Keep the named columns, in this order."""
    return df.select(*[column(n) for n in names])


def drop_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Drop the named columns; names that are not there are ignored."""
    return df.drop(*names)


def rename_columns(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename ``{old: new}``; an unknown old name is an error, never a silent no-op."""
    _require(df, names)
    return df.withColumnsRenamed(dict(names))


def doubles_to_int(df: DataFrame, wide: Collection[str] = ()) -> DataFrame:
    """Turn every double column into an integer one, the others stay.

    Columns in ``wide`` become 64-bit integers.
    """
    _require(df, wide)
    return df.select(
        *[
            truncate_to_int(column(f.name), f.name in wide).alias(f.name)
            if isinstance(f.dataType, T.DoubleType)
            else column(f.name)
            for f in df.schema
        ]
    )


def sparse_columns(df: DataFrame, threshold: float = 0.9) -> list[str]:
    """Names of the columns whose share of missing values exceeds ``threshold``.

    One aggregate over the table; a single row of counts reaches the driver.
    """
    counts = null_profile(df, rows=ROWS).first().asDict()
    rows = counts.pop(ROWS)
    return [name for name, n in counts.items() if rows and n > threshold * rows]


def drop_sparse(df: DataFrame, threshold: float = 0.9) -> DataFrame:
    """Drop the columns found by :func:`sparse_columns`."""
    return df.drop(*sparse_columns(df, threshold))
