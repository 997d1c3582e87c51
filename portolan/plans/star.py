"""The fact table and its summary over the dimensions."""

from __future__ import annotations

import functools
import operator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portolan import schemas
from portolan.operators import exact_average, lookup_join, rename_columns
from portolan.sinks import Staging


def build_fact(
    arrivals: DataFrame,
    visatype: DataFrame,
    null_safe: bool = False,
    limit: int | None = None,
    staging: Staging | None = None,
) -> DataFrame:
    """Cleaned arrivals with the visa type replaced by its key.

    ``visatype`` should be the stored dimension, so that the keys in the fact
    are the stored ones. A null visa type gets no key unless ``null_safe``.
    """
    fact = rename_columns(arrivals, schemas.FACT_NAMES)
    return lookup_join(fact, visatype, {"visatype": "visatype"}, null_safe, limit, staging).drop("visatype")


def star_summary(
    fact: DataFrame,
    country: DataFrame,
    calendar: DataFrame,
    visatype: DataFrame,
    limit: int | None = None,
    staging: Staging | None = None,
    years: tuple[int, int] | None = None,
) -> DataFrame:
    """Arrivals and mean temperature per country, year of arrival and visa type.

    The fact table is first counted by its three foreign keys. That needs no
    dimension and reduces any number of arrivals to at most codes x dates x
    visa types; the dimensions then meet these few rows. Temperatures are
    weighted by the counts, which equals averaging over the arrivals.

    ``years``, the first and the last one wanted, leaves other arrivals, and those without a
    date, out. The calendar says which dates these are; the first and the last of them
    are fetched and filter the fact, whose files are in the order of dates.
    """
    if years is not None:
        calendar = calendar.where(F.col("arrival_year").between(*years))
        first, last = calendar.agg(F.min("arrdate"), F.max("arrdate")).first()
        # Without such a date the comparison is null, and no arrival is left.
        fact = fact.where(F.col("arrdate").between(F.lit(first), F.lit(last)))
    counted = fact.groupBy("country_residence_code", "arrdate", "visa_type_key").agg(
        F.count(F.lit(1)).alias("n")
    )
    staging = staging or Staging(fact.sparkSession)
    joined = staging.write(counted, "counted")
    for dim, on in (
        (country, {"country_residence_code": "country_code"}),
        (calendar.select("arrdate", "arrival_year"), {"arrdate": "arrdate"}),
        (visatype.select("visa_type_key", "visatype"), {"visa_type_key": "visa_type_key"}),
    ):
        joined = lookup_join(joined, dim, on, limit=limit, staging=staging)
    if years is not None:
        joined = joined.where(F.col("arrival_year").isNotNull())
    by = ["country_name", "arrival_year", "visa_type_key", "visatype"]
    # Few rows are left, and both parts have a row per group.
    joined = staging.write(joined, "joined")
    counts = joined.groupBy(*by).agg(F.sum("n").alias("arrivals"))
    means = exact_average(joined, by, F.col("average_temperature"), "average_temperature", F.col("n"))
    same = functools.reduce(operator.and_, [counts[c].eqNullSafe(means[c]) for c in by])
    return counts.join(means, same).select(*[counts[c] for c in by], "arrivals", "average_temperature")
