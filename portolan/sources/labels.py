"""Label catalogues: text lines of the form ``code = 'name'``."""

from __future__ import annotations

import functools
import operator
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from portolan.operators.dedup import keep_one
from portolan.operators.joins import lookup_join
from portolan.sinks.staging import Staging

# A pair is a code, then the text from the quote up to a second
# "=" or the end; a section runs from its header to a line that ends in ";".
LABEL_LINE = r"^\s*([^=]*?)\s*=\s*'([^=]*)"
SECTION_HEADER = r"(?i)^\s*value\s+\$?{}\s*$"
SECTION_END = r";\s*$"


def parse_label_lines(lines: DataFrame, order: Sequence[str], line: str = "value") -> DataFrame:
    """Lines to ``(code, name)``; a repeated code keeps its last line.

    Lines that are no ``code = 'name'`` pair (headers, blanks, terminators) are
    left out. ``order`` names the columns that give the line order. Text after
    a second ``=`` is not part of the name; quotes, blanks and a closing ``;``
    around the name are removed.
    """
    text = F.col(line)
    name = F.regexp_extract(text, LABEL_LINE, 2)
    pairs = lines.where(text.rlike(LABEL_LINE)).select(
        F.regexp_extract(text, LABEL_LINE, 1).alias("code"),
        F.regexp_replace(name, r"'*\s*;?\s*$", "").alias("name"),
        *order,
    )
    last_first = [F.col(c).desc() for c in order]
    return keep_one(pairs, ["code"], last_first).select("code", "name")


def _section(lines: DataFrame, section: str, staging: Staging) -> DataFrame:
    """The lines of each file from the section's header to the end of its statement.

    Two lookups by file with one row per file; the lines themselves stay where
    they are, so a section may be of any length. ``lines`` is read several
    times.
    """
    begins = (
        lines.where(F.col("value").rlike(SECTION_HEADER.format(section)))
        .groupBy("file")
        .agg(F.min("spot").alias("begin"))
    )
    begins = staging.write(begins, "begins")
    after = lookup_join(lines, begins, {"file": "file"}, staging=staging).where(F.col("spot") > F.col("begin"))
    ends = (
        after.where(F.col("value").rlike(SECTION_END)).groupBy("file").agg(F.min("spot").alias("end"))
    )
    ends = staging.write(ends, "ends")
    return lookup_join(after, ends, {"file": "file"}, staging=staging).where(
        F.col("end").isNull() | (F.col("spot") <= F.col("end"))
    )


def read_label_catalog(
    spark: SparkSession, path: str, section: str | None = None, staging: Staging | None = None
) -> DataFrame:
    """Read a label file or a folder of such files as ``(code, name)``.

    The order of lines is file, then offset of the split, then place within
    the split, so files may be split freely over tasks. With ``section`` only
    the statement headed ``value <section>`` counts, else every line.
    """
    lines = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.struct(
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("place"),
        ).alias("spot"),
    )
    if section is not None:
        # Stored once, and only lines that matter, so that the text is scanned once.
        text = F.col("value")
        matter = [LABEL_LINE, SECTION_HEADER.format(section), SECTION_END]
        staging = staging or Staging(spark)
        lines = staging.write(lines.where(functools.reduce(operator.or_, [text.rlike(x) for x in matter])), "labels")
        lines = _section(lines, section, staging)
    return parse_label_lines(lines, ["file", "spot"])
