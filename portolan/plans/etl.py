"""The whole job: sources to checked star tables on storage."""

from __future__ import annotations

import dataclasses
import functools
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from portolan import schemas
from portolan.operators import (
    check_not_empty,
    check_not_null,
    check_references,
    check_unique,
    cleaning_loss,
    counted_loss,
    raise_on_failure,
)
from portolan.plans.cleaning import NULLED, arrival_counts, clean_arrivals, clean_demographics, clean_temperature
from portolan.plans.dimensions import (
    build_calendar_dimension,
    build_country_dimension,
    build_demographics_dimension,
    build_key_dimension,
)
from portolan.plans.layers import read_fact
from portolan.plans.star import build_fact
from portolan.sinks import Release, Staging, path_exists, write_parquet
from portolan.sources import load_table


@dataclasses.dataclass(frozen=True)
class StarTables:
    """The five stored tables."""

    visatype: DataFrame
    immigration_time: DataFrame
    country: DataFrame
    demographics: DataFrame
    immigration_fact: DataFrame
    # What cleaning lost, see :func:`loss_report`; lines that could not be read; the checks. Not part of the star.
    losses: DataFrame | None = None
    rejects: DataFrame | None = None
    checks: DataFrame | None = None
    # Whether dimensions hold rows of earlier runs.
    extended: bool = False

    def named(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in STAR}


STAR = ["visatype", "immigration_time", "country", "demographics", "immigration_fact"]


# Columns that identify a row of each table, and columns that must be filled.
UNIQUE = [
    ("immigration_time", ["id"]),
    ("immigration_time", ["arrdate"]),
    ("demographics", ["id"]),
    ("demographics", ["City", "State", "state_code", "Race"]),
    ("visatype", ["visa_type_key"]),
    ("visatype", ["visatype"]),
    ("country", ["country_code"]),
    ("immigration_fact", ["record_id"]),
]
# Links of the fact table.
LINKS = {
    "country_residence_code": ("country", "country_code"),
    "arrdate": ("immigration_time", "arrdate"),
    "visa_type_key": ("visatype", "visa_type_key"),
}
FILLED = {
    "immigration_fact": ["record_id"],
    "visatype": ["visa_type_key"],
    "immigration_time": ["arrdate"],
    "demographics": ["City", "state_code"],
    "country": ["country_code"],
}


def store_table(df: DataFrame, folder: str, name: str) -> DataFrame:
    """Write a table of the star below ``folder`` in its layout; gives the stored table."""
    path = f"{folder.rstrip('/')}/{name}"
    layout = {}
    if name == "immigration_time":
        # Only the calendar is partitioned: its folders hold at most a week.
        layout = {"partition_by": schemas.CALENDAR_PARTITIONS, "small_folders": True}
    elif name == "immigration_fact":
        # A date's arrivals may be many; their ids cut them.
        layout = {"order_by": ["arrdate", "record_id"]}
    write_parquet(df, path, comments=schemas.COMMENTS[name], **layout)
    return load_table(df.sparkSession, path)


def store_rejects(rejected: Mapping[str, DataFrame] | None, folder: str) -> DataFrame | None:
    """Write the lines of all sources that could not be read as ``(source, line, bad_columns)``."""
    if not rejected:
        return None
    lines = [df.select(F.lit(name).alias("source"), "line", "bad_columns") for name, df in rejected.items()]
    lines, path = functools.reduce(DataFrame.unionByName, lines), f"{folder.rstrip('/')}/rejects"
    write_parquet(lines, path)
    return load_table(lines.sparkSession, path)


def build_star(
    arrivals: DataFrame,
    demographics: DataFrame,
    temperature: DataFrame,
    mapping: DataFrame,
    output: str,
    rare_duplicates: bool = True,
    staging: Staging | None = None,
    previous: StarTables | None = None,
    rejected: Mapping[str, DataFrame] | None = None,
) -> StarTables:
    """Clean the sources, build the star and store it below ``output``.

    Tables that are there are replaced one after the other; a star that has
    readers goes through :func:`publish_star`. With the ``previous`` star, which must lie
    elsewhere, visa types, dates and cities keep the keys that they have
    there, and values that no longer occur keep their rows; a country's code is its key.
    ``rejected`` has the lines of each source that could not be read, as
    :func:`read_csv_with_rejects` gives them; they are stored and counted.


    The cleaned arrivals feed four tables; they are staged once, so that all
    four agree and the sort behind the clean-up runs once. Each dimension then
    reads a single column of them. Tables that do not wait for each other are
    written at the same time, which keeps the cluster busy while small ones
    finish. Staged tables are deleted at the end, unless the caller passes a
    ``staging`` of their own.
    """
    if staging is None:
        staging = Staging(arrivals.sparkSession)
        try:
            return build_star(
                arrivals, demographics, temperature, mapping, output, rare_duplicates, staging, previous, rejected
            )
        finally:
            staging.clear()
    spark = arrivals.sparkSession

    def old(name: str) -> DataFrame | None:
        return previous.named()[name] if previous else None

    def store(df: DataFrame, name: str) -> DataFrame:
        return store_table(df, output, name)

    def losses_table(counts: DataFrame) -> DataFrame:
        path = f"{output.rstrip('/')}/cleaning_losses"
        report = loss_report(arrivals, demographics, temperature, counts)
        if rejects is not None:
            report = with_rejected(report, rejects)
        write_parquet(report, path)
        return load_table(spark, path)

    rejects = store_rejects(rejected, output)

    def demographics_table() -> DataFrame:
        cities = staging.write(clean_demographics(demographics), "demographics")
        return store(build_demographics_dimension(cities, staging=staging, stored=old("demographics")), "demographics")

    def calendar_table(cleaned: DataFrame) -> DataFrame:
        calendar = build_calendar_dimension(cleaned, staging=staging, stored=old("immigration_time"))
        return store(calendar, "immigration_time")

    def country_table(cleaned: DataFrame) -> DataFrame:
        readings = clean_temperature(temperature)
        return store(build_country_dimension(cleaned, mapping, readings, staging=staging), "country")

    with ThreadPoolExecutor(max_workers=4) as pool:
        cities = pool.submit(inheritable_thread_target(spark)(demographics_table))
        counts = staging.write(arrival_counts(arrivals), "arrival-counts")
        losses = pool.submit(inheritable_thread_target(spark)(losses_table), counts)
        cleaned = staging.write(
            clean_arrivals(arrivals, rare_duplicates=rare_duplicates, staging=staging, counts=counts), "arrivals"
        )
        calendar = pool.submit(inheritable_thread_target(spark)(calendar_table), cleaned)
        country = pool.submit(inheritable_thread_target(spark)(country_table), cleaned)
        visatype = store(
            build_key_dimension(cleaned, "visatype", "visa_type_key", staging, old("visatype")), "visatype"
        )
        fact = store(build_fact(cleaned, visatype, staging=staging), "immigration_fact")
        return StarTables(
            visatype=visatype,
            immigration_time=calendar.result(),
            country=country.result(),
            demographics=cities.result(),
            immigration_fact=fact,
            losses=losses.result(),
            rejects=rejects,
            extended=previous is not None,
        )


def open_star(spark: SparkSession, output: str, version: str | None = None) -> StarTables:
    """The published star below ``output``, or a stated version of it."""
    release = Release(spark, output)
    version = version or release.current()
    if version is None:
        raise ValueError(f"nothing has been published below {output}")
    folder = release.folder(version)
    extra = {"losses": "cleaning_losses", "rejects": "rejects", "checks": "checks"}
    there = {n: load_table(spark, f"{folder}/{path}") for n, path in extra.items() if path_exists(spark, f"{folder}/{path}")}
    tables = {name: load_table(spark, f"{folder}/{name}") for name in STAR if name != "immigration_fact"}
    return StarTables(**tables, immigration_fact=read_fact(release, version), **there)


def publish_star(
    arrivals: DataFrame,
    demographics: DataFrame,
    temperature: DataFrame,
    mapping: DataFrame,
    output: str,
    *,
    strict: bool = True,
    keep_keys: bool = True,
    rare_duplicates: bool = True,
    staging: Staging | None = None,
    rejected: Mapping[str, DataFrame] | None = None,
) -> StarTables:
    """Build a new version of the star, check it, and only then let readers take it.

    The version lies in a folder of its own (see :class:`Release`); readers
    find the published one by :func:`open_star`. Its checks are stored with
    it. If one fails, ``ValueError`` is raised, the version stays unpublished
    for inspection, and readers keep the tables that they have; with
    ``strict`` off it is published all the same. ``keep_keys`` gives values of
    the published star the keys that they have there. One run at a time may
    publish below ``output``.
    """
    spark = arrivals.sparkSession
    release = Release(spark, output)
    previous = open_star(spark, output) if keep_keys and release.current() else None
    version = release.new()
    folder = release.folder(version)
    tables = build_star(
        arrivals, demographics, temperature, mapping, folder, rare_duplicates, staging, previous, rejected
    )
    write_parquet(check_star(tables), f"{folder}/checks")
    checks = load_table(spark, f"{folder}/checks")
    if strict:
        raise_on_failure(checks)
    release.publish(version)
    return dataclasses.replace(tables, checks=checks)


def check_star(tables: StarTables) -> DataFrame:
    """All checks of the star as ``(check_name, table_name, columns, measured, status)``.

    ``measured`` is the number of rows, of keys that occur more than once, of
    nulls, of fact rows whose key a dimension lacks, or of rows that a table
    has more or fewer than it should: the fact and the demographics as many as
    cleaning left (if the losses are known), the country and the calendar as
    many as the fact has codes and dates. A star that holds rows of earlier
    runs may have more dates and cities, but not fewer.
    """
    frames = tables.named()
    filled = check_not_empty(frames).select(
        F.lit("not_empty").alias("check_name"),
        "table_name",
        F.lit("").alias("columns"),
        F.col("row_count").alias("measured"),
        "status",
    )
    # One aggregate per key; the tables' names may repeat.
    unique = [check_unique({n: (frames[n], keys)}) for n, keys in UNIQUE]
    unique = functools.reduce(DataFrame.unionByName, unique).select(
        F.lit("unique").alias("check_name"),
        "table_name",
        F.col("key_columns").alias("columns"),
        F.col("duplicate_groups").alias("measured"),
        "status",
    )
    nulls = check_not_null({n: (frames[n], columns) for n, columns in FILLED.items()}).select(
        F.lit("not_null").alias("check_name"),
        "table_name",
        F.col("column_name").alias("columns"),
        F.col("null_values").alias("measured"),
        "status",
    )
    fact = tables.immigration_fact
    links = check_references({("immigration_fact", k): (fact, frames[d], c) for k, (d, c) in LINKS.items()}).select(
        F.lit("references").alias("check_name"),
        "table_name",
        F.col("column_name").alias("columns"),
        F.col("orphans").alias("measured"),
        "status",
    )
    parts = [filled, unique, nulls, links, _completeness(tables)]
    return functools.reduce(DataFrame.unionByName, parts)


# Dimensions that keep the rows of earlier runs.
MERGED = ("immigration_time", "demographics")


def _completeness(tables: StarTables) -> DataFrame:
    count = F.count(F.lit(1)).alias("n")
    fact, frames = tables.immigration_fact, tables.named()
    expected = {
        "country": fact.select("country_residence_code").distinct().agg(count),
        "immigration_time": fact.select("arrdate").distinct().agg(count),
    }
    if tables.losses is not None:
        after = F.coalesce(F.sum("after"), F.lit(0)).alias("n")
        for name, source in (("immigration_fact", "arrivals"), ("demographics", "demographics")):
            expected[name] = tables.losses.where(F.col("source") == source).agg(after)
    results = []
    for name, wanted in expected.items():
        both = frames[name].agg(count).unionAll(wanted.select(-F.col("n")))
        surplus = F.sum("n")
        off = F.greatest(-surplus, F.lit(0)) if tables.extended and name in MERGED else F.abs(surplus)
        measured, status = off.alias("measured"), F.when(off == 0, "PASS").otherwise("FAIL").alias("status")
        results.append(
            both.agg(measured, status).select(
                F.lit("complete").alias("check_name"), F.lit(name).alias("table_name"), F.lit("").alias("columns"), "measured", "status"
            )
        )
    return functools.reduce(DataFrame.unionByName, results)


def loss_report(
    arrivals: DataFrame, demographics: DataFrame, temperature: DataFrame, counts: DataFrame | None = None
) -> DataFrame:
    """Rows before, dropped and after cleaning, one row per source.

    ``nulled_keys`` and ``nulled_values`` count what became null in retyping:
    record keys, and values of any column (keys included). ``counts`` are the
    stored :func:`arrival_counts`, if there are any; the arrivals are then not read.
    """
    counts = arrival_counts(arrivals) if counts is None else counts
    parts = {
        "arrivals": counted_loss(counts, NULLED),
        "demographics": cleaning_loss(
            demographics, schemas.REQUIRED_DEMOGRAPHICS, schemas.DEMOGRAPHICS_KEY
        ),
        "temperature": cleaning_loss(
            temperature, schemas.REQUIRED_TEMPERATURE, schemas.TEMPERATURE_KEY
        ),
    }
    rows = [df.select(F.lit(n).alias("source"), "*") for n, df in parts.items()]
    both = functools.reduce(functools.partial(DataFrame.unionByName, allowMissingColumns=True), rows)
    return both.na.fill(0)


def with_rejected(report: DataFrame, rejects: DataFrame) -> DataFrame:
    """The loss report with the number of lines of each source that could not be read; every such source has a row."""
    count = rejects.groupBy("source").agg(F.count(F.lit(1)).alias("rejected"))
    numbers = [c for c in report.columns if c != "source"]
    both = report.withColumn("rejected", F.lit(0).cast("bigint")).unionByName(count, allowMissingColumns=True)
    return both.groupBy("source").agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in [*numbers, "rejected"]])
