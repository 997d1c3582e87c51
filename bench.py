"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` is the folder of the test tables, ``BENCH_CPUS`` the number of
local cores. Every query runs once to warm up and then ``BENCH_RUNS`` times
(default 3); the median counts. Results are computed in full and discarded.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from workload.queries import QUERIES  # noqa: E402

HEADLINE = [
    "star_summary", "star_summary_shuffled", "star_checks", "clean_arrivals", "clean_temperature", "clean_demographics",
    "fact_dim_key", "fact_dim_key_nullsafe", "fact_dim_key_shuffled",
    "country_dim", "country_dim_titled", "calendar_dim", "demographics_dim", "dim_surrogate_key",
    "dense_key_large", "dedup_single_key", "dedup_composite_key", "dedup_rare_keys", "dropna_any",
    "null_profile", "null_percent", "drop_sparse_columns", "all_doubles_to_int", "avg_by_group",
    "cleaning_loss", "dedup_loss", "quality_duplicate_key", "quality_null_key", "quality_row_count",
    "partitioned_roundtrip", "parquet_roundtrip", "csv_roundtrip", "label_catalog",
    "sas_date", "title_case", "row_count",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    wanted = sys.argv[1:] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("portolan-bench")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in wanted:
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:]), 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "sum of median query times",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
                "cpus": cpus,
                "runs": runs,
            }
        )
    )


if __name__ == "__main__":
    main()
