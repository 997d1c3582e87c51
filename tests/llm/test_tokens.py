import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from portolan.llm import library, words
from portolan.llm import token_counts as tc
from portolan.llm import token_files as tf
from tests.llm import brute
from tests.llm.conftest import frame


def ids_of(text):
    return brute.LIBRARY.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("small", ["", "FILE_TEXT_BYTES", "FILE_IDS"])
def test_files_give_back_every_document(spark, docs, corpus, staging, monkeypatch, small):
    if small:
        monkeypatch.setattr(tf, small, 20_000 if small == "FILE_TEXT_BYTES" else 2_000)
        monkeypatch.setattr(tf, "BLOCK_BYTES", 10_000)
    folder = staging.path("tokens")
    tf.write_tokens(docs, folder, brute.VOCABULARY, sequence=64)
    out = tf.read_documents(spark, folder).orderBy("start").collect()
    assert (len({r.file for r in out}) > 1) == bool(small)
    numbers = [r.doc_id for r in out]
    assert numbers == sorted(numbers, key=lambda d: (d is not None, d or 0))
    texts, start = {d: t for d, t in corpus}, 0
    for r in out:
        ids = [*ids_of(texts[r.doc_id]), 1]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_random_access_without_a_copy(tmp_path):
    ids = np.arange(1, 64 * 300 + 8, dtype="<u2")
    data = tf.arrow_file(3, [ids[:10], ids[10:10], ids[10:]], [5, None], np.array([10, len(ids) - 10]), 64)
    path = tmp_path / "f.arrow"
    path.write_bytes(data.to_pybytes())
    before = pa.total_allocated_bytes()
    file = tf.TokenFile(pa.memory_map(str(path)))
    own, mask = file.sequence(270)
    assert own.tolist() == ids[270 * 64 : 271 * 64].tolist() and not own.flags.owndata
    assert pa.total_allocated_bytes() - before < 10_000
    own, mask = file.sequence(300)
    assert mask.to_pylist() == [True] * 7 + [False] * 57 and own[:7].tolist() == ids[-7:].tolist()
    assert file.stream().tolist() == ids.tolist() and file.doc_ids == [5, None] and file.starts.tolist() == [0, 10]


def test_equal_rows_are_cut_over_files(spark, staging, monkeypatch):
    monkeypatch.setattr(tf, "FILE_TEXT_BYTES", 20_000)
    text = "the same row again, " * 20
    docs = staging.write(spark.range(0, 600, 1, 6).select(F.lit(7).alias("doc_id"), F.lit(text).alias("text")), "equal")
    folder = staging.path("tokens")
    tf.write_tokens(docs, folder, brute.VOCABULARY, sequence=64)
    out = tf.read_documents(spark, folder).orderBy("start").collect()
    sizes = Counter(r.file for r in out)
    assert len(out) == 600 and len(sizes) > 5 and max(sizes.values()) < 200
    n = len(ids_of(text)) + 1
    assert [r.start for r in out] == list(range(0, 600 * n, n)) and len({r.ids_crc32 for r in out}) == 1


ODD = [
    None, "", " \n", "one", "ONE,two.3x44 <|endoftext|> it's we're' a'b<c>d", "x<|startoftext|>y", "tab\x1cfs\x1d", "é ß İ Σς 漢字 \u0085 end", "a", "b",
    "word" * 5000, "!" * 300 + "9" * 300, "o\u0301 e\u0301", " lead", "trail ", "\x00nul", "k\u212a AZ az @[`{",
]


@pytest.mark.parametrize("block", [1, 40, 1 << 20])
@pytest.mark.parametrize("remembered", [0, 2000, 1 << 20])
@pytest.mark.parametrize("ends", [True, False])
def test_ids_are_those_of_the_library(monkeypatch, block, remembered, ends):
    monkeypatch.setattr(library, "REMEMBERED_BYTES", remembered)
    monkeypatch.setattr(library, "_JOINED", 3)
    coder = library.LibraryCoder(brute.VOCABULARY)
    assert coder.ends is not None
    if not ends:  # a vocabulary without marks of word ends
        coder.ends = None
    for texts in (ODD, ODD[::-1], ODD[4:9] * 3, [], [None, ""]):
        at = 0
        for first, sizes, ids in coder.run(pa.array(texts, pa.string()), block):
            assert first == at
            for part in np.split(ids, np.cumsum(sizes)[:-1]):
                assert part.tolist() == ids_of(texts[at])
                at += 1
        assert at == len(texts)
    assert coder.known.nbytes <= remembered


def test_units_of_one_hash(monkeypatch):
    monkeypatch.setattr(words.Block, "hashes", lambda self: (self.ends - self.starts).astype(np.uint64))
    coder = library.LibraryCoder(brute.VOCABULARY)
    texts = ["abc def", "ghi", "abc", None, "def no, on!"]
    for _ in range(2):
        _, sizes, ids = next(coder.run(pa.array(texts, pa.string())))
        assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == [ids_of(t) for t in texts]


def test_no_documents_no_files(spark, empty, staging):
    folder = staging.path("none")
    tf.write_tokens(empty, folder, brute.VOCABULARY)
    assert tf.read_documents(spark, folder).count() == 0


def test_counts(docs, corpus, empty, monkeypatch):
    for frequent in (100_000, 3):  # with and without words for the second tier
        monkeypatch.setattr(tc, "FREQUENT", frequent)
        out = {r.doc_id: r.n_tokens for r in tc.count_tokens(docs, brute.VOCABULARY).collect()}
        assert out == {d: len(ids_of(t)) for d, t in corpus}
    assert tc.count_tokens(empty, brute.VOCABULARY).count() == 0


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "piece_bpe_32k.model"])
def test_counts_of_vocabularies_with_white_space(docs, corpus, name):
    import public_tokenizers

    path = public_tokenizers.path(name)
    out = {r.doc_id: r.n_tokens for r in tc.count_tokens(docs, path).collect()}
    assert out == dict(zip([d for d, _ in corpus], tc._counter(path)([t or "" for _, t in corpus]), strict=True))


def test_table_with_collisions():
    rng = np.random.default_rng(0)
    h = np.unique(np.concatenate((rng.integers(0, 1 << 63, 1000, dtype=np.uint64), np.arange(1, 300, dtype=np.uint64))))
    n = rng.integers(1, 255, len(h))
    table = tc.Table(h, n)
    assert table.lengths(h).tolist() == n.tolist() and table.probes > 200
    assert not table.lengths(h + np.uint64(1 << 62)).any()


@pytest.mark.parametrize("partitions", [1, 3])
def test_frequent_words_are_those_of_all_texts(spark, monkeypatch, partitions):
    """More texts than a share of them would hold, and more words than a task once kept."""
    monkeypatch.setattr(tc, "SAMPLE_BYTES", 2000, raising=False)
    monkeypatch.setattr(tc, "FREQUENT", 30_000)
    made, init = [], tc.Table.__init__
    monkeypatch.setattr(tc.Table, "__init__", lambda self, hashes, lengths: made.append(hashes) or init(self, hashes, lengths))
    texts = [" ".join(f"w{j}" for j in range(300 * i, 300 * i + 600)) for i in range(100)] + [None, "", "w1 w1 w2"]
    out = tc.count_tokens(frame(spark, list(enumerate(texts)), partitions), brute.VOCABULARY)
    n = Counter(w for t in texts for w in (t or "").split())
    top = sorted(n, key=lambda w: (-n[w], w))[:30_000]
    want = np.concatenate([b.hashes() for b in words.blocks(pa.array(top, pa.string()))])
    assert made[0].tolist() == want.tolist() and len(want) == 30_000
    assert {r.doc_id: r.n_tokens for r in out.collect()} == {i: len(ids_of(t)) for i, t in enumerate(texts)}


@pytest.mark.parametrize("limit", ["COUNTED_WORDS", "COUNTED_BYTES"])
def test_word_counts_add_up_however_they_are_handed_on(monkeypatch, limit):
    monkeypatch.setattr(tc, limit, 10)
    texts = ["a b a", None, "", "c a\tb\nc", "d" * 50, "a \u00e9 a", "e f g h i j k l m n o p"]
    batches = [pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"])] * 3
    parts = [Counter(dict(zip(*b.to_pydict().values(), strict=True))) for b in tc._word_counts(iter(batches))]
    assert len(parts) > 1 and sum(parts, Counter()) == Counter(w for t in texts * 3 for w in (t or "").split())


@pytest.mark.parametrize("k", [1, 7, 50, 1000])
def test_most_frequent_words(spark, k):
    rng = np.random.default_rng(5)
    counts = [(f"w{i}", int(n)) for i, n in enumerate(rng.zipf(1.3, 400).clip(max=1 << 40))]
    out = tc._most_frequent(spark.createDataFrame(counts, "word string, n long"), k)
    assert [tuple(r) for r in out.collect()] == sorted(counts, key=lambda x: (-x[1], x[0]))[:k]
