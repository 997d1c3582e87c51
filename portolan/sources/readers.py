"""File readers."""

from __future__ import annotations

import functools
import operator
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from portolan.functions import column
from portolan.sinks.staging import Staging
from portolan.sources.records import read_records, regular

LINE = "__line"
# Stands for a value without any character, which is null; a quoted empty value is an empty text.
NO_VALUE = "\u0000none\u0000"


def load_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Read a table whose format carries its own schema."""
    return spark.read.format(fmt).load(path)


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    sep: str = ",",
    escape: str = '"',
    multiline: bool = False,
    staging: Staging | None = None,
) -> DataFrame:
    """Read CSV with a header line.

    A value or line that does not fit the types fails the query, also one that
    reads other columns, filters or merely counts; see
    :func:`read_csv_with_rejects` for setting such lines aside.

    With a ``schema`` the file is read once and its header is checked against
    the schema; without one the types are inferred, which costs a further pass
    over the file. Values may be quoted and hold the separator; a value without
    any character is null, a quoted empty one is an empty text.

    ``multiline`` allows line breaks within quoted values. With a schema and
    doubled quotes (the default ``escape``) the byte ranges of a file are
    parsed in parallel; its lines and records are stored in ``staging``, or in
    a folder of its own, and a record in which a quote does not enclose a
    whole value fails the query. Line ends within values stay as written. Otherwise a file is read by one task.
    """
    if schema is not None:
        schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
        if multiline and escape == '"':
            rows = _parsed_records(spark, path, schema, sep, "FAILFAST", staging or Staging(spark))
        else:
            rows = _csv_reader(spark, sep, escape, multiline).option("mode", "FAILFAST").schema(schema)
            rows = rows.option("enforceSchema", False).csv(path)
        return _all_parsed(rows)
    return _all_parsed(_csv_reader(spark, sep, escape, multiline).option("mode", "FAILFAST").option("inferSchema", True).csv(path))


def _options(sep: str, escape: str, multiline: bool) -> dict[str, str]:
    return {"sep": sep, "escape": escape, "multiLine": str(multiline).lower(), "nullValue": NO_VALUE, "emptyValue": "", "columnPruning": "false"}


def _csv_reader(spark: SparkSession, sep: str, escape: str, multiline: bool):
    return spark.read.option("header", True).options(**_options(sep, escape, multiline))


def _all_parsed(rows: DataFrame) -> DataFrame:
    """``rows``, of which every value is read whatever a query needs.

    The condition always holds, refers to all columns, and lets no other
    condition pass to the file because it is not deterministic.
    """
    bit = F.xxhash64(*[column(c) for c in rows.columns]).bitwiseAND(F.lit(1))
    return rows.where(bit <= F.lit(1) + F.floor(F.rand(0)))


def _parsed_records(spark: SparkSession, path: str, schema: StructType, sep: str, mode: str, staging: Staging) -> DataFrame:
    """Rows of CSV files from their records; ``mode`` as in Spark's reader."""
    options = _options(sep, '"', True) | {"mode": mode, "columnNameOfCorruptRecord": LINE}
    records = read_records(spark, path, staging)
    names = [f.name for f in schema if f.name != LINE]
    ddl = ", ".join(f"c{i} string" for i in range(len(names)))
    found = F.from_csv("text", F.lit(ddl), _options(sep, '"', True))
    right = [F.lower(found[f"c{i}"]) == n.lower() for i, n in enumerate(names)]
    right = functools.reduce(operator.and_, right) & (F.size(F.split(F.regexp_replace("text", '"[^"]*"', ""), re.escape(sep))) == len(names))
    wrong = F.raise_error(F.concat(F.lit(f"{path}: the header is not {sep.join(names)} but "), "text")).cast("boolean")
    bad_quotes = F.raise_error(F.concat(F.lit(f"{path}: a quote does not enclose a whole value in the record "), "text")).cast("boolean")
    row = F.when(F.col("is_header"), F.when(F.coalesce(right, F.lit(False)), False).otherwise(wrong)).when(
        F.col("text").rlike(regular(sep)), True
    ).otherwise(bad_quotes)
    parsed = F.from_csv("text", F.lit(", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)), options)
    return records.where(row).select(parsed.alias("row")).select("row.*")


def read_csv_with_rejects(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    sep: str = ",",
    escape: str = '"',
    multiline: bool = False,
    staging: Staging | None = None,
    index: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Rows that fit the schema, and ``(line, bad_columns)`` of the lines that do not.

    ``bad_columns`` names the columns whose value could not be read, which are
    null in spite of a text in the line; it is empty for a line with too many
    or too few values. The file is parsed once; its rows are stored for both
    frames in ``staging``, or in a folder of its own. ``multiline`` as in
    :func:`read_csv`. ``index`` names a first column that has no name in the
    file and is left out of the rows, as in :func:`read_indexed_csv`.
    """
    schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    staging = staging or Staging(spark)
    if index:
        _check_indexed_header(spark, path, sep, schema.names, index)
        schema = StructType([StructField(index, StringType()), *schema.fields])
    whole = StructType([*schema.fields, StructField(LINE, StringType())])
    if multiline and escape == '"':
        rows = _parsed_records(spark, path, whole, sep, "PERMISSIVE", staging)
    else:
        reader = _csv_reader(spark, sep, escape, multiline).option("enforceSchema", index is not None)
        rows = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", LINE).schema(whole).csv(path)
    rows = staging.write(rows, "csv-rows")
    good = rows.where(F.col(LINE).isNull()).drop(LINE, *([index] if index else []))
    texts = F.from_csv(
        F.col(LINE), F.lit(", ".join(f"c{i} string" for i in range(len(schema)))), _options(sep, escape, True)
    ).alias("__texts")
    bad = rows.where(F.col(LINE).isNotNull()).select("*", texts)
    lost = [
        F.when(column(f.name).isNull() & F.col(f"__texts.c{i}").isNotNull(), F.lit(f.name)) for i, f in enumerate(schema)
    ]
    return good, bad.select(F.col(LINE).alias("line"), F.array_compact(F.array(*lost)).alias("bad_columns"))


def read_indexed_csv(spark: SparkSession, path: str, schema: str, index: str = "_c0") -> DataFrame:
    """CSV whose first column is an index without a name; the index is left out.

    The header is compared with the schema, but for the index.
    """
    _check_indexed_header(spark, path, ",", StructType.fromDDL(schema).names, index)
    reader = _csv_reader(spark, ",", '"', False).option("mode", "FAILFAST")
    return _all_parsed(reader.schema(f"{index} string, {schema}").csv(path)).drop(index)


def _check_indexed_header(spark: SparkSession, path: str, sep: str, names: list[str], index: str) -> None:
    found = spark.read.option("header", True).option("sep", sep).csv(path).columns
    if found != [index, *names]:
        raise ValueError(f"{path}: the header is {found}, not an index and {names}")


def file_inventory(spark: SparkSession, glob: str) -> DataFrame:
    """Name and size in bytes of every file behind ``glob``.

    Only the listing is used; the content column is pruned away, so no file is
    opened. Spark leaves out files of zero bytes.
    """
    files = spark.read.format("binaryFile").load(glob)
    return files.selectExpr("regexp_extract(path, '([^/]+)$', 1) AS file_name", "length AS size_bytes")
