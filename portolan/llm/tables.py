"""What several operators of this package need of Spark tables."""

from __future__ import annotations

import functools
import math
import re
import shutil
import tempfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from portolan.sinks import Staging

ROW = "__row"


def ship(spark: SparkSession) -> None:
    """Let the Python workers of every executor import this package, as ``--py-files`` would."""
    _ship(spark.sparkContext.applicationId, spark)


@functools.lru_cache(maxsize=1)
def _ship(application_id: str, spark: SparkSession) -> None:
    package = Path(__file__).resolve().parent.parent
    if not package.is_dir():  # it came as an archive, which Spark has sent already
        return
    folder = tempfile.mkdtemp(prefix="portolan-code-")
    archive = shutil.make_archive(f"{folder}/{package.name}", "zip", package.parent, package.name)
    spark.sparkContext.addPyFile(archive)


def documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Bits of a row's number that tell its file; the rest are the row's place in it.
# Of these choices of bits and of a salt for the hash the first one counts under which no two files share a hash.
FILE_BITS = ((14, 0), (24, 0), (34, 0), (40, 0), (40, 1), (40, 2))


def numbered(docs: DataFrame) -> DataFrame:
    """Add ``__row``, which tells rows apart even if their ids and texts are equal.

    The number is made of the row's file and its place there, so it stays the
    same however Spark cuts the files into tasks, on any number of cores and
    in every job. ``docs`` must be a scan of Parquet files, see :func:`stored`.
    A file is told by a hash of its path, of as few bits as tell all files of
    the table apart; only a path per file is looked at for that. A file with
    more rows than the other bits can number fails the query.
    """
    meta = docs.metadataColumn("_metadata")
    path = meta["file_path"]

    def slot(c, bits: int, salt: int):
        return F.shiftrightunsigned(F.xxhash64(c, F.lit(salt)), 64 - bits)

    files = docs.select(path.alias("path")).distinct()
    told = [F.count_distinct(slot(F.col("path"), b, s)).alias(f"c{b}_{s}") for b, s in FILE_BITS]
    found = files.agg(F.count(F.lit(1)).alias("n"), *told).first()
    bits, salt = next((b, s) for b, s in FILE_BITS if found[f"c{b}_{s}"] == found["n"])
    place = F.when(meta["row_index"] < F.lit(1 << (63 - bits)), meta["row_index"]).otherwise(
        F.raise_error(F.lit(f"a file has more than 2^{63 - bits} rows")).cast("long")
    )
    return docs.withColumn(ROW, F.shiftleft(slot(path, bits, salt), 63 - bits) + place)


def stored(docs: DataFrame, staging: Staging, label: str = "docs") -> DataFrame:
    """``docs`` itself if it merely reads columns of Parquet files, else a stored copy of it."""
    plan = docs._jdf.queryExecution().optimizedPlan()
    while plan.nodeName() == "Project":
        plan = plan.child()
    scan = "Relation" in plan.nodeName() and re.search(r"\] parquet\s*$", plan.toString())
    return docs if scan else staging.write(docs, label)


def text_bytes(docs: DataFrame, text: str) -> int:
    """UTF-8 bytes of all texts; sizes partitions and hash widths, never results."""
    return docs.select(F.sum(F.octet_length(F.col(text).cast("string")))).first()[0] or 0


def pieces(total: float, each: float) -> int:
    return max(1, math.ceil(total / each))


def components(edges: DataFrame, staging: Staging, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components: one row (node, root) per node, the root being its smallest node.

    Each round points every node at its smallest neighbour, shortens these
    paths by two jumps and contracts the edges to the ends reached. At least
    half of the nodes left vanish in each round, so a few rounds do. A node
    with very many neighbours is reduced by partial aggregation; no list of
    neighbours is ever made. Every table is stored, none reaches the driver.
    """
    # Both directions come from one evaluation: a second one might give other edges of the same components.
    ways = F.explode(F.array(F.struct(F.col(a).alias("u"), F.col(b).alias("v")), F.struct(F.col(b).alias("u"), F.col(a).alias("v"))))
    edges = edges.select(ways.alias("way")).select("way.u", "way.v")
    both = staging.write(edges.where("u <> v").distinct(), "edges")
    labels = None
    while True:
        up = both.groupBy("u").agg(F.min("v").alias("v")).select("u", F.least("u", "v").alias("p"))
        up = staging.write(up, "parents")
        up = staging.write(_jumped(_jumped(up)), "parents")
        if labels is None:
            labels = up.select(F.col("u").alias("node"), F.col("p").alias("root"))
        else:
            step = up.select(F.col("u").alias("root"), F.col("p").alias("q"))
            labels = labels.join(step, "root", "left").select("node", F.coalesce("q", "root").alias("root"))
        ends = both.join(up, "u").select(F.col("p").alias("u"), "v")
        ends = ends.join(up.select(F.col("u").alias("v"), F.col("p").alias("q")), "v").select("u", F.col("q").alias("v"))
        both = staging.write(ends.where("u <> v").distinct(), "edges")
        if both.isEmpty():
            return labels


def _jumped(up: DataFrame) -> DataFrame:
    """Each node's parent replaced by that parent's own parent."""
    jump = up.select(F.col("u").alias("p"), F.col("p").alias("q"))
    return up.join(jump, "p", "left").select("u", F.coalesce("q", "p").alias("p"))
