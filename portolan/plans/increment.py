"""A day's arrivals, added to the published star."""

from __future__ import annotations

import dataclasses
import functools
import operator
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portolan import schemas
from portolan.operators import dedup, lookup_join, raise_on_failure, rename_columns
from portolan.plans.cleaning import arrival_counts, clean_arrivals, clean_demographics, clean_temperature
from portolan.plans.dimensions import (
    build_calendar_dimension,
    build_country_dimension,
    build_demographics_dimension,
    build_key_dimension,
)
from portolan.plans.etl import (
    StarTables,
    check_star,
    loss_report,
    open_star,
    publish_star,
    store_rejects,
    store_table,
    with_rejected,
)
from portolan.plans.layers import Layer, beyond, month_of, read_fact, read_layers, within, write_layers
from portolan.plans.star import build_fact
from portolan.sinks import Release, Staging, write_parquet
from portolan.sources import load_table

# From so many layers on, an increment writes the whole fact as one.
MAX_LAYERS = 32


def publish_increment(
    arrivals: DataFrame,
    demographics: DataFrame,
    temperature: DataFrame,
    mapping: DataFrame,
    output: str,
    *,
    strict: bool = True,
    rare_duplicates: bool = True,
    staging: Staging | None = None,
    rejected: Mapping[str, DataFrame] | None = None,
    max_layers: int = MAX_LAYERS,
) -> StarTables:
    """Add arrivals to the published star, and publish the result as a new version.

    The outcome is that of :func:`publish_star` over all arrivals so far: of
    records with the same key, of whichever increment, the same one stays. The
    other three sources are small and are given whole, as they are now.
    Without a published star this is a whole run.

    Of the stored fact only the record ids are read, which tells the months
    that hold a record of the increment, and then those months. They and the
    months of the new records are written; all others stay where they are (see
    :mod:`portolan.plans.layers`) and are read from there. With ``max_layers``
    layers the whole fact is written again as one, which changes no row.

    The losses of the arrivals are those of all increments together. Stored
    rejects are those of this increment. Checks, ``strict`` and the other
    options are those of :func:`publish_star`. An increment without arrivals
    publishes the same fact.
    """
    if staging is None:
        staging = Staging(arrivals.sparkSession)
        try:
            return publish_increment(
                arrivals, demographics, temperature, mapping, output, strict=strict,
                rare_duplicates=rare_duplicates, staging=staging, rejected=rejected, max_layers=max_layers,
            )
        finally:
            staging.clear()
    spark = arrivals.sparkSession
    release = Release(spark, output)
    base = release.current()
    if base is None:
        return publish_star(
            arrivals, demographics, temperature, mapping, output,
            strict=strict, rare_duplicates=rare_duplicates, staging=staging, rejected=rejected,
        )
    stored = open_star(spark, output, base)
    version = release.new()
    folder = release.folder(version)
    layers = read_layers(release, base)
    # Noted first: a clean-up must not take what this run reads.
    release.require(version, [layer.version for layer in layers])

    counts = staging.write(arrival_counts(arrivals), "arrival-counts")
    new = staging.write(
        clean_arrivals(arrivals, rare_duplicates=rare_duplicates, staging=staging, counts=counts), "arrivals"
    )
    met = staging.write(_met(stored.immigration_fact, new), "met")
    found = new.select(month_of(F.col("arrdate")).alias("month")).union(met.select("month")).distinct()
    # At most the months of a calendar.
    months = frozenset(r.month for r in found.collect())
    merged = staging.write(_merged(stored, new, met, months, staging), "merged")

    rejects = store_rejects(rejected, folder)

    def demographics_table() -> DataFrame:
        cities = staging.write(clean_demographics(demographics), "demographics")
        dim = build_demographics_dimension(cities, staging=staging, stored=stored.demographics)
        return store_table(dim, folder, "demographics")

    def calendar_table() -> DataFrame:
        dim = build_calendar_dimension(merged, staging=staging, stored=stored.immigration_time)
        return store_table(dim, folder, "immigration_time")

    def losses_table() -> DataFrame:
        report = loss_report(arrivals, demographics, temperature, counts)
        if rejects is not None:
            report = with_rejected(report, rejects)
        write_parquet(_added(stored.losses, report, new.count() - met.count()), f"{folder}/cleaning_losses")
        return load_table(spark, f"{folder}/cleaning_losses")

    with ThreadPoolExecutor(max_workers=3) as pool:
        cities = pool.submit(inheritable_thread_target(spark)(demographics_table))
        losses = pool.submit(inheritable_thread_target(spark)(losses_table))
        days = pool.submit(inheritable_thread_target(spark)(calendar_table))
        visatype = build_key_dimension(merged, "visatype", "visa_type_key", staging, stored.visatype)
        visatype = store_table(visatype, folder, "visatype")
        fact = build_fact(merged, visatype, staging=staging)
        if len(layers) >= max_layers:
            layers = [Layer(version)]
            fact = fact.unionByName(stored.immigration_fact.where(beyond(F.col("arrdate"), months)))
        else:
            layers = [*layers, Layer(version, months)]
        store_table(fact, folder, "immigration_fact")
        write_layers(release, version, layers)
        fact = read_fact(release, version, layers)
        readings = clean_temperature(temperature)
        country = build_country_dimension(fact, mapping, readings, code="country_residence_code", staging=staging)
        tables = StarTables(
            visatype=visatype,
            immigration_time=days.result(),
            country=store_table(country, folder, "country"),
            demographics=cities.result(),
            immigration_fact=fact,
            losses=losses.result(),
            rejects=rejects,
            extended=True,
        )
    write_parquet(check_star(tables), f"{folder}/checks")
    checks = load_table(spark, f"{folder}/checks")
    if strict:
        raise_on_failure(checks)
    # The fact may stand alone again.
    release.require(version, [layer.version for layer in layers if layer.version != version])
    release.publish(version)
    return dataclasses.replace(tables, checks=checks)


def _met(fact: DataFrame, new: DataFrame) -> DataFrame:
    """``(met, month)`` of the stored records whose key the increment has, from their ids and dates alone.

    Keys, null among them, are unique on both sides, so the join has no hot key.
    """
    ids = fact.select(F.col("record_id").alias("met"), month_of(F.col("arrdate")).alias("month"))
    keys = new.select(F.col(schemas.ARRIVALS_KEY[0]).alias("__key"))
    return ids.join(keys, F.col("met").eqNullSafe(F.col("__key")), "left_semi")


def _merged(
    stored: StarTables, new: DataFrame, met: DataFrame, months: frozenset[int], staging: Staging
) -> DataFrame:
    """All records of the months, in the shape of cleaned arrivals.

    Only records that both sides have are compared; the others pass.
    """
    key = schemas.ARRIVALS_KEY[0]
    rows = stored.immigration_fact.where(within(F.col("arrdate"), months))
    # A null visa type found no key and gets none back.
    kinds = stored.visatype.select("visatype", "visa_type_key").where(F.col("visatype").isNotNull())
    rows = lookup_join(rows, kinds, {"visa_type_key": "visa_type_key"}, staging=staging)
    rows = rename_columns(rows, {b: a for a, b in schemas.FACT_NAMES.items()}).select(new.columns)
    same = F.col(key).eqNullSafe(F.col("met"))
    met = met.select("met")
    both = rows.join(met, same, "left_semi").unionByName(new.join(met, same, "left_semi"))
    alone = rows.join(met, same, "left_anti").unionByName(new.join(met, same, "left_anti"))
    return alone.unionByName(dedup(both, schemas.ARRIVALS_KEY))


def _added(before: DataFrame, report: DataFrame, fresh: int) -> DataFrame:
    """The loss report with the arrivals of earlier runs added; ``fresh`` keys are new to the star."""
    arrivals = F.col("source") == "arrivals"
    now = report.where(arrivals).withColumn("after", F.lit(fresh).cast("bigint"))
    both = now.unionByName(before.where(arrivals), allowMissingColumns=True)
    numbers = [c for c in both.columns if c != "source"]
    total = both.groupBy("source").agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in numbers])
    left = functools.reduce(operator.sub, [F.col(c) for c in ("before", "dropped_missing", "after")])
    others = report.where(~arrivals).unionByName(total.limit(0), allowMissingColumns=True).na.fill(0)
    return total.withColumn("dropped_duplicates", left).unionByName(others)
