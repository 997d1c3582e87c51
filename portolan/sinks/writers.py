"""Writers. All of them overwrite the target folder."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portolan.functions import column


# Tasks that write a table of many small folders.
FOLDER_TASKS = 64


def with_comments(df: DataFrame, comments: Mapping[str, str]) -> DataFrame:
    """Attach column comments; Parquet keeps them and gives them back."""
    for name, text in comments.items():
        if name in df.columns:
            df = df.withMetadata(name, {"comment": text})
    return df


def write_parquet(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    comments: Mapping[str, str] | None = None,
    small_folders: bool = False,
    order_by: Sequence[str] = (),
) -> None:
    """Write Parquet, optionally one folder per value of ``partition_by``.

    For a partitioned table the rows are rebalanced on the partition columns
    first. A small folder then gets one file instead of one per task, while a
    folder with a large share of the rows is split over several tasks by size,
    which a plain ``repartition`` on the same columns would not do.

    ``small_folders`` is for a table whose every folder is known to be small,
    such as a calendar. There the cost is the number of files, not their size;
    folders are spread over a fixed number of tasks, which adaptive execution
    would otherwise merge into one.

    ``order_by`` is for a table without folders: rows are dealt out by ranges of
    these columns and sorted within each file, so that a filter on the first
    of them reads only the files and row groups that its values lie in. A last
    column that differs from row to row lets a frequent value be cut, too.
    """
    if order_by and partition_by:
        raise ValueError("a table has either folders or ranges")
    if comments:
        df = with_comments(df, comments)
    if not partition_by:
        if order_by:
            keys = [column(c) for c in order_by]
            df = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
        df.write.mode("overwrite").parquet(path)
        return
    # Whatever the session says, folders of an earlier run go.
    by = [column(c) for c in partition_by]
    if small_folders:
        shuffle_partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        df = df.repartition(min(FOLDER_TASKS, shuffle_partitions), *by)
    else:
        df = df.hint("rebalance", *by)
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*partition_by).parquet(path)


def write_csv(df: DataFrame, path: str, sep: str = ",") -> None:
    """Write CSV with a header and without any index column.

    Quotes inside a value are doubled, the form other tools read, and blanks
    at either end of a value are kept. An empty text is written in quotes, a
    null as nothing, which :func:`read_csv` tells apart.
    """
    writer = df.write.mode("overwrite").option("header", True).option("sep", sep).option("escape", '"')
    writer = writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    writer.option("emptyValue", '""').option("nullValue", "").csv(path)


def write_text(df: DataFrame, path: str, line: str = "value") -> None:
    """Write one text column as lines."""
    df.select(F.col(line).alias("value")).write.mode("overwrite").text(path)
