"""Dimension builders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portolan import schemas
from portolan.functions import calendar_parts, column, title_case
from portolan.operators import (
    add_dense_key,
    average_by,
    distinct_values,
    lookup_join,
    merge_dimension,
    rename_columns,
)
from portolan.sinks import Staging


def _with_key(
    df: DataFrame, natural: Sequence[str], key: str, staging: Staging, stored: DataFrame | None
) -> DataFrame:
    """Dense keys in natural order; if the dimension is stored already, its keys and then further ones."""
    if stored is None:
        return add_dense_key(df, natural, key, staging)
    return merge_dimension(df, stored, natural, key, staging)


def build_key_dimension(
    df: DataFrame, name: str, key: str, staging: Staging | None = None, stored: DataFrame | None = None
) -> DataFrame:
    """Distinct values of one column, each with a dense key; null is kept as a row.

    With the ``stored`` dimension of an earlier run its values keep their
    keys, here and in the other builders. The distinct values are staged, so that the source is read once however
    the key is then made.
    """
    staging = staging or Staging(df.sparkSession)
    values = staging.write(distinct_values(df, name), "values")
    return _with_key(values, [name], key, staging, stored)


def build_calendar_dimension(
    df: DataFrame,
    date: str = "arrdate",
    prefix: str = "arrival_",
    key: str = "id",
    staging: Staging | None = None,
    stored: DataFrame | None = None,
) -> DataFrame:
    """One row per distinct date with its calendar parts.

    The distinct values are staged and counted, because nothing bounds them:
    the column may hold timestamps, or dates far beyond year 9999.
    """
    staging = staging or Staging(df.sparkSession)
    days = staging.write(distinct_values(df, date), "days")
    return _with_key(days.withColumns(calendar_parts(column(date), prefix)), [date], key, staging, stored)


def build_country_dimension(
    df: DataFrame,
    mapping: DataFrame,
    temperature: DataFrame,
    code: str = "i94res",
    titled: bool = True,
    staging: Staging | None = None,
) -> DataFrame:
    """``(country_code, country_name, average_temperature)`` for every code in ``df``.

    Codes are made distinct before they meet the mapping, so that the joins
    handle codes and not arrivals. Without a mapping row the name is null,
    without readings under that name the average is null. ``titled``
    title-cases the names, which is how the readings spell them; otherwise
    names are compared as they are. Of several names of a code in ``mapping``
    the first in alphabetical order counts, so that a code has one row.
    """
    staging = staging or Staging(df.sparkSession)
    codes = distinct_values(df, code).withColumnRenamed(code, "country_code")
    name = title_case(F.col("Name")) if titled else F.col("Name")
    names = mapping.groupBy("code").agg(F.min(name).alias("country_name"))
    averages = staging.write(
        average_by(temperature, "Country", "AverageTemperature", "average_temperature"), "averages"
    )
    named = lookup_join(codes, names, {"country_code": "code"}, staging=staging)
    return lookup_join(named, averages, {"country_name": "Country"}, staging=staging)


def build_demographics_dimension(
    df: DataFrame, key: str = "id", staging: Staging | None = None, stored: DataFrame | None = None
) -> DataFrame:
    """Demographics in snake case with a dense key in order of city, state and race."""
    staging = staging or Staging(df.sparkSession)
    renamed = rename_columns(df, schemas.DEMOGRAPHICS_NAMES)
    order = [schemas.DEMOGRAPHICS_NAMES.get(c, c) for c in schemas.DEMOGRAPHICS_KEY]
    return _with_key(renamed, order, key, staging, stored)
