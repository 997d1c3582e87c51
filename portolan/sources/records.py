"""Records of CSV files whose values hold line breaks, found in parallel.

A line begins a record if an even number of quotes stands before it in its
file. Files are read in byte ranges, as any text; each range counts its quotes,
a running sum over the ranges tells whether a range begins within quotes, and so
every range finds its own records. Those that go over the end of a range are put
together from at most two pieces per range.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from portolan.sinks.staging import Staging

RANGE = ["path", "start"]


def _lines(spark: SparkSession, path: str, staging: Staging) -> DataFrame:
    """Lines with their file, byte range and place, and whether their number of quotes is odd.

    Stored once: how files are cut depends on the cores that a job meets, and
    the counts must be those of the very ranges that are joined later.
    """
    lines = spark.read.option("lineSep", "\n").text(path)
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    lines = lines.select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("place"),
        (quotes % 2).alias("odd"),
        "value",
    )
    return staging.write(lines, "csv-lines")


def _joined(pieces: str, *order: str):
    """Texts of a list of structs put together in order."""
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(*order, pieces))), lambda x: x[pieces]), "\n")


def read_records(spark: SparkSession, path: str, staging: Staging) -> DataFrame:
    """``(text, is_header)``: every record of the files, the first of each file marked.

    A record ends with a line feed, or carriage return and line feed, outside
    quotes; quotes within values are doubled. Blank records are left out.
    """
    lines = _lines(spark, path, staging)
    before = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    # A row per byte range.
    ranges = lines.groupBy(*RANGE).agg(F.sum("odd").alias("odd_lines"))
    ranges = ranges.select(*RANGE, (F.coalesce(F.sum("odd_lines").over(before), F.lit(0)) % 2).alias("inside"))
    in_range = Window.partitionBy(*RANGE).orderBy("place")
    earlier = F.coalesce(F.sum("odd").over(in_range.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    begins = lines.join(ranges, RANGE).withColumn("begins", ((earlier + F.col("inside")) % 2 == 0).cast("int"))
    # Record 0 of a range is the end of one that began before it.
    numbered = begins.withColumn("record", F.sum("begins").over(in_range))
    found = numbered.groupBy(*RANGE, "record").agg(
        _joined("value", "place").alias("text"), (F.sum("odd") % 2 == 1).alias("odd")
    )
    found = staging.write(found, "csv-records")
    cut = (F.col("record") == 0) | F.col("odd")
    whole = found.where(~cut)
    # At most two rows per byte range.
    opened = F.when((F.col("record") > 0) & F.col("odd"), F.col("start"))
    so_far = Window.partitionBy("path").orderBy("start", "record").rowsBetween(Window.unboundedPreceding, 0)
    pieces = found.where(cut).withColumn("owner", F.last(opened, ignorenulls=True).over(so_far))
    merged = pieces.groupBy("path", "owner").agg(
        _joined("text", "start", "record").alias("text"), F.min_by("record", F.struct("start", "record")).alias("record")
    )
    records = whole.select("start", "record", "text").unionByName(merged.select(F.col("owner").alias("start"), "record", "text"))
    text = F.regexp_replace("text", r"\r\z", "")
    records = records.select(text.alias("text"), ((F.col("start") == 0) & (F.col("record") == 1)).alias("is_header"))
    return records.where(F.col("is_header") | (F.trim("text") != ""))


def regular(sep: str) -> str:
    """A pattern of records whose quotes enclose whole values; only for these the count of quotes tells records apart."""
    other = re.escape(sep)
    value = f'(?:"[^"]*+"(?:"[^"]*+")*+|[^"{other}]*+)'
    return rf"\A{value}(?:{other}{value})*+\z"
