"""Command line: ``spark-submit`` or ``python -m portolan`` runs the whole job."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from portolan.plans import run_etl
from portolan.sinks import Release


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="portolan", description="Build and check the arrivals star schema.")
    parser.add_argument("--arrivals", required=True)
    parser.add_argument("--arrivals-format", default="parquet")
    parser.add_argument("--demographics", required=True)
    parser.add_argument("--temperature", required=True)
    parser.add_argument("--mapping", required=True)
    parser.add_argument("--output", required=True)
    parser.add_argument("--infer", action="store_true", help="infer CSV types")
    parser.add_argument("--rejects", action="store_true", help="set CSV lines aside that do not fit, instead of failing")
    parser.add_argument("--lenient", action="store_true", help="publish the tables even when a check fails")
    parser.add_argument("--new-keys", action="store_true", help="number the dimensions anew")
    parser.add_argument("--increment", action="store_true", help="add the arrivals to those of the published star")
    parser.add_argument("--keep", type=int, help="delete all but so many versions older than the published one")
    args = parser.parse_args(argv)

    spark = SparkSession.builder.appName("portolan").getOrCreate()
    tables = run_etl(
        spark,
        args.arrivals,
        args.demographics,
        args.temperature,
        args.mapping,
        args.output,
        args.arrivals_format,
        args.infer,
        args.rejects,
        not args.lenient,
        not args.new_keys,
        args.increment,
    )
    print(*tables.losses.columns, sep="\t")
    for row in tables.losses.collect():
        print(*row, sep="\t")
    # A row per check.
    for row in tables.checks.collect():
        print(row.status, row.check_name, row.table_name, row.columns, row.measured, sep="\t")
    if args.keep is not None:
        Release(spark, args.output).prune(args.keep)


if __name__ == "__main__":
    main()
