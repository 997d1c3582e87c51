"""Text corpus to training ids in five stages, each one operator of ``portolan.llm``.

Each stage takes all that its predecessor kept, stored as Parquet. All but the
last return the columns of the documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from portolan.llm.bpe_texts import encode_decode
from portolan.llm.decontaminate import find_leaks
from portolan.llm.near_dedup import near_duplicates
from portolan.llm.quality import select
from portolan.llm.queries import vocabulary
from portolan.llm.substring_dedup import remove_repeats
from portolan.llm.tables import ROW, documents, numbered, ship, stored
from portolan.sinks import Staging

RECORD = "record"


def _with_record(docs: DataFrame) -> DataFrame:
    """All columns in one, beside the two that operators read; so no name can clash with theirs."""
    return docs.select(F.struct("*").alias(RECORD), "doc_id", "text")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents that importance resampling selects."""
    ship(spark)
    out = select(_with_record(docs), documents(spark, sf_dir, "labels"), staging=Staging(spark))
    return out.where("selected").select(f"{RECORD}.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each near-duplicate group: the one of smallest id."""
    ship(spark)
    staging = Staging(spark)
    docs = stored(_with_record(docs), staging)
    groups = near_duplicates(docs, shingle_words=5, percent=80, staging=staging)
    stay = groups.where("first_row").select(ROW)
    return numbered(docs.select(RECORD)).join(stay, ROW, "left_semi").select(f"{RECORD}.*")


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Remove word runs of 20 and more that occur earlier; a document left without a word goes."""
    ship(spark)
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    out = remove_repeats(docs, min_words=20, staging=Staging(spark), carry=rest, as_is=True)
    out = out.where("n_removed < n_words OR n_words = 0")
    columns = {c: F.col(f"{RECORD}.`{c}`") for c in docs.columns if c != "text"} | {"text": F.col("kept")}
    if "n_chars" in columns:
        columns["n_chars"] = F.when(F.col("n_removed") > 0, F.length("kept").cast("long")).otherwise(columns["n_chars"])
    return out.select(*[columns[c].alias(c) for c in docs.columns])


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark item."""
    ship(spark)
    out = find_leaks(_with_record(docs), documents(spark, sf_dir, "benchmark"))
    return out.where(F.size("leaks") == 0).select(f"{RECORD}.*")


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encode each text, and decode it again as proof."""
    ship(spark)
    out = encode_decode(docs.select("doc_id", "text"), vocabulary())
    return out.select("doc_id", "bpe.n_tokens", "bpe.ids", "bpe.ids_sha256", "bpe.decoded_sha256")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("decontamination", decontamination),
    ("bpe", bpe),
]

# No SQL: hashed n-gram models, token merges and Hamming look-ups have no form in it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    staging = Staging(spark)
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = staging.write(stage(spark, docs, sf_dir), name)
    return docs
