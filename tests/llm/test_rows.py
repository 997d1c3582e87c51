"""Row numbers that do not depend on how files are cut into tasks."""

import pytest
from pyspark.sql import functions as F

from portolan.llm.near_dedup import near_duplicates
from portolan.llm.queries import documents
from portolan.llm.tables import ROW, numbered, stored

SF = "/root/testdata/sf0.01"


@pytest.fixture
def cores(spark):
    """Sets the number of tasks that a scan is cut into."""
    name = "spark.sql.files.minPartitionNum"
    yield lambda n: spark.conf.set(name, str(n))
    spark.conf.unset(name)


def test_numbers_stay(spark, staging, cores, tmp_path):
    path = str(tmp_path / "docs")
    documents(spark, SF).select("doc_id", "text").repartition(10).write.parquet(path)
    docs = spark.read.parquet(path)
    cores(2)
    few = staging.write(numbered(docs).select(ROW, "doc_id"), "few")
    cores(16)
    many = numbered(docs).select(F.col(ROW).alias("other"), F.col("doc_id").alias("id"))
    assert docs.rdd.getNumPartitions() >= 10
    assert few.join(many, (F.col("doc_id") == F.col("id")) & (F.col(ROW) == F.col("other"))).count() == docs.count()
    assert few.select(ROW).distinct().count() == docs.count()


def test_near_duplicates_keep_all_rows_when_cores_change(spark, staging, cores, monkeypatch):
    docs = documents(spark, SF).select("doc_id", "text")
    write, n = staging.write, iter(range(10**6))

    def changing(df, label):
        cores(2 if next(n) % 2 else 16)
        return write(df, label)

    cores(2)
    monkeypatch.setattr(staging, "write", changing)
    out = near_duplicates(docs, shingle_words=4, staging=staging).select("doc_id", "component_id", "kept")
    got = sorted(map(tuple, out.collect()))
    monkeypatch.undo()
    want = near_duplicates(docs, shingle_words=4, staging=staging).select("doc_id", "component_id", "kept")
    assert got == sorted(map(tuple, want.collect())) and len(got) == docs.count()


def test_only_plain_parquet_scans_are_taken_as_they_are(spark, staging, tmp_path):
    docs = documents(spark, SF)
    assert stored(docs, staging) is docs
    chosen = docs.select("text")
    assert stored(chosen, staging) is chosen
    docs.limit(3).select("doc_id").write.csv(str(tmp_path / "csv"))
    for df in (docs.where("doc_id > 3"), spark.read.schema("doc_id long").csv(str(tmp_path / "csv")), docs.limit(3)):
        assert stored(df, staging) is not df and numbered(stored(df, staging)).select(ROW).distinct().count() == df.count()


def test_columns_called_metadata_do_not_matter(spark, staging):
    docs = staging.write(spark.range(10).withColumn("_metadata", F.lit("mine")), "docs")
    assert numbered(docs).select(ROW).distinct().count() == 10 and numbered(docs.limit(0).select("id")).columns == ["id", ROW]
