"""The stages and the registered queries."""

import pytest

import __spark_entry__ as entry_module
import corpus_pipeline
from portolan.llm.queries import ORACLE, QUERIES
from tests.llm import brute

SF = "/root/testdata/sf0.001"


def test_registered():
    assert [n for n in range(1, 11) if not any(q.startswith(f"op{n}_") for q in QUERIES)] == [] and "pipeline" in QUERIES
    assert set(QUERIES) <= set(entry_module.queries()) and set(ORACLE) <= set(QUERIES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_dedup", "substring_dedup", "decontamination", "bpe"]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What each stage reads and gives, as lists of rows."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        given = docs.collect()
        result = stage(spark, docs, SF)
        columns = docs.columns
        result.write.parquet(path)
        docs = spark.read.parquet(path)
        out.append((name, columns, docs.columns, given, docs.collect()))
    return {x[0]: x[1:] for x in out}


def test_columns_stay(stages):
    for name, (before, after, _, _) in stages.items():
        assert name == "bpe" or before == after == ["doc_id", "text", "lang", "source", "n_chars"]


def test_quality(stages):
    _, _, given, kept = stages["quality"]
    assert 0 < len(kept) <= len(given) and set(kept) <= set(given)


def test_near_dedup(stages):
    _, _, given, kept = stages["near_dedup"]
    rows = [(r.doc_id, r.text) for r in given]
    want = {d for (d, _), (_, c) in zip(rows, brute.components(rows, 5), strict=True) if d == c}
    assert {r.doc_id for r in kept} == want and set(kept) <= set(given)


def test_substring_dedup(stages):
    _, _, given, kept = stages["substring_dedup"]
    given = sorted(given)
    want = {}
    for r, (n, gone, text) in zip(given, brute.removed([(r.doc_id, r.text) for r in given], 20), strict=True):
        if gone < n or not n:
            want[r.doc_id] = (text, len(text)) if gone else (r.text, r.n_chars)
    assert {r.doc_id: (r.text, r.n_chars) for r in kept} == want


def test_decontamination(spark, stages):
    _, _, given, kept = stages["decontamination"]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    leaking = {r.doc_id for r in given if any(t in r.text for _, t in items)}
    assert {r.doc_id for r in kept}.isdisjoint(leaking) and set(kept) <= set(given)
    for r in {*given} - {*kept}:
        assert max(brute.leaks(r.text, items).values()) >= 0.8


def test_bpe(stages):
    _, columns, given, out = stages["bpe"]
    assert columns[:3] == ["doc_id", "n_tokens", "ids"]
    texts = {r.doc_id: r.text for r in given}
    assert {r.doc_id: list(r.ids) for r in out} == {d: brute.LIBRARY.encode(t, add_special_tokens=False).ids for d, t in texts.items()}


def test_stages_take_odd_and_empty_tables(spark, docs, empty):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0
        assert stage(spark, docs, SF).count() > 0
