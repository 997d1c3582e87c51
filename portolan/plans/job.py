"""The job of the command line: source files to a published star."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from portolan import schemas
from portolan.plans.etl import StarTables, publish_star
from portolan.plans.increment import publish_increment
from portolan.sinks import Staging
from portolan.sources import load_table, read_csv, read_csv_with_rejects, read_indexed_csv


def run_etl(
    spark: SparkSession,
    arrivals_path: str,
    demographics_path: str,
    temperature_path: str,
    mapping_path: str,
    output: str,
    arrivals_format: str = "parquet",
    infer: bool = False,
    rejects: bool = False,
    strict: bool = True,
    keep_keys: bool = True,
    increment: bool = False,
) -> StarTables:
    """Read the four sources from files, build the star below ``output``, check and publish it.

    CSV sources are read with the schemas of :mod:`portolan.schemas`, or with
    inferred types when ``infer`` is set. Arrivals as CSV have an unnamed index
    column first; they are stored as Parquet before they are read again and
    again. A line that does not fit its schema fails the run; with ``rejects``
    such lines are stored beside the star, with their source, and counted in
    the losses. With ``increment`` the arrivals are added to those of the
    published star, see :func:`publish_increment`. See :func:`publish_star` for
    the other options.
    """
    if increment and not keep_keys:
        raise ValueError("an increment keeps the keys of the star that it is added to")
    if rejects and infer:
        raise ValueError("lines are set aside by a schema, not by inferred types")
    staging = Staging(spark)
    rejected: dict[str, DataFrame] = {}

    def csv(path: str, schema: str, source: str, sep: str = ",", index: str | None = None) -> DataFrame:
        if rejects:
            good, rejected[source] = read_csv_with_rejects(spark, path, schema, sep, staging=staging, index=index)
            return good
        return read_csv(spark, path, None if infer else schema, sep)

    try:
        if arrivals_format == "csv" and rejects:
            arrivals = csv(arrivals_path, schemas.ARRIVALS, "arrivals", index="_c0")
        elif arrivals_format == "csv":
            text = read_csv(spark, arrivals_path).drop("_c0") if infer else read_indexed_csv(spark, arrivals_path, schemas.ARRIVALS)
            arrivals = staging.write(text, "arrivals-csv")
        else:
            arrivals = load_table(spark, arrivals_path, arrivals_format)
        options = {} if increment else {"keep_keys": keep_keys}
        publish = publish_increment if increment else publish_star
        return publish(
            arrivals,
            csv(demographics_path, schemas.DEMOGRAPHICS, "demographics", ";"),
            csv(temperature_path, schemas.TEMPERATURE, "temperature"),
            csv(mapping_path, schemas.MAPPING, "mapping"),
            output,
            strict=strict,
            staging=staging,
            rejected=rejected,
            **options,
        )
    finally:
        staging.clear()
