"""The registered queries of this package and the SQL that some are compared with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from portolan.llm.alignment import link_statistics
from portolan.llm.bpe_texts import encode_decode
from portolan.llm.decontaminate import find_leaks
from portolan.llm import language
from portolan.llm.fingerprint import with_edits
from portolan.llm.near_dedup import near_duplicates
from portolan.llm.negatives import mine
from portolan.llm.neighbours import nearest
from portolan.llm.quality import select
from portolan.llm.substring_dedup import remove_repeats
from portolan.llm.tables import documents, ship
from portolan.llm.token_counts import count_tokens
from portolan.llm.token_files import read_documents, write_tokens
from portolan.llm.warc import archive, read_archives
from portolan.sinks import Staging


VOCABULARY = "word_bpe_49k.json"


def vocabulary(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    out = find_leaks(documents(spark, sf_dir).select("doc_id", "text"), documents(spark, sf_dir, "benchmark"))
    best = F.get("leaks", F.lit(0))
    return out.select(
        "doc_id",
        (F.size("leaks") > 0).alias("contaminated"),
        best["item_id"].alias("item_id"),
        best["similarity"].alias("similarity"),
        F.transform("leaks", lambda x: x["item_id"]).alias("item_ids"),
    )


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    staging = Staging(spark)
    folder = staging.path("tokens")
    write_tokens(documents(spark, sf_dir), folder, vocabulary(), end=1, staging=staging)
    return read_documents(spark, folder).select("doc_id", "start", "n_tokens", "ids_crc32")


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    out = encode_decode(documents(spark, sf_dir).select("doc_id", "text"), vocabulary())
    return out.select("doc_id", "bpe.n_tokens", "bpe.ids_sha256", "bpe.decoded_sha256")


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    staging = Staging(spark)
    folder = staging.path("archives")
    archive(documents(spark, sf_dir, "pages"), folder, staging=staging)
    return read_archives(spark, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    docs = documents(spark, sf_dir).select("doc_id", "text")
    out = select(docs, documents(spark, sf_dir, "labels"), staging=Staging(spark))
    return out.select("doc_id", "log_weight", "gumbel_key", "selected")


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2
    model = language.fit(docs.where(F.coalesce(~held_out, F.lit(False))))
    out = language.identify(docs.drop("lang"), model)
    return out.select(
        "doc_id", held_out.alias("held_out"), F.col("language.lang").alias("lang_pred"), F.col("language.score").alias("score")
    )


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    out = remove_repeats(documents(spark, sf_dir), min_words=20, staging=Staging(spark))
    return out.select("record.doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op8_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_edits(documents(spark, sf_dir), Staging(spark))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    out = count_tokens(documents(spark, sf_dir).select("doc_id", "text"), vocabulary())
    return out.select(
        "doc_id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        "n_tokens",
        (F.col("n_tokens") > 2048).alias("over_limit"),
    )


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    out = near_duplicates(documents(spark, sf_dir), shingle_words=4, percent=80, staging=Staging(spark))
    return out.select("doc_id", "n_shingles", "component_id", "kept")


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    docs = documents(spark, sf_dir).select("doc_id", "text")
    out = link_statistics(docs, vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"), staging=Staging(spark))
    return out.select(
        F.col("record.doc_id").cast("long").alias("doc_id"), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(documents(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label=label, staging=Staging(spark))


def op13_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return nearest(documents(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20, staging=Staging(spark))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline  # beside the package; it imports this module

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontaminate": op1_decontaminate,
    "op2_token_files": op2_token_files,
    "op3_bpe": op3_bpe,
    "op4_warc": op4_warc,
    "op5_quality": op5_quality,
    "op6_language": op6_language,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_fingerprint": op8_fingerprint,
    "op9_token_counts": op9_token_counts,
    "op10_near_dedup": op10_near_dedup,
    "op11_alignment": op11_alignment,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_nearest": op13_nearest,
    "pipeline": pipeline,
}

# The whole query set against all rows: for the small tables that SQL is compared on.
ORACLE: dict[str, str] = {
    "op12_hard_negatives": """
        WITH kept AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
            FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ),
        scored AS (
            SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same, list_inner_product(a.v, r.v)::BIGINT AS score
            FROM kept a JOIN kept r ON a.vec_id <> r.vec_id
            WHERE a.vec_id % 100 = 0
        ),
        positives AS (
            SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
        )
        SELECT p.anchor_id, p.positive_id,
               (row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id))::INT AS rank,
               s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
        FROM positives p JOIN scored s ON p.anchor_id = s.anchor_id
        WHERE NOT s.same AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
        QUALIFY rank <= 10
    """
}
