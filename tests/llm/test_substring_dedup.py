import numpy as np
import pytest

from portolan.llm import substring_dedup as sd
from tests.llm import brute


def order(row):
    return (row[0] is not None, row[0] or 0)


@pytest.mark.parametrize("length", [20, 7, 40])
def test_equals_brute_force(docs, corpus, staging, length, monkeypatch):
    monkeypatch.setattr(sd, "UNIT_BYTES", 2000)
    monkeypatch.setattr(sd, "BUCKET_RUNS", 500)
    out = sd.remove_repeats(docs, min_words=length, staging=staging, carry=["kept", "lang"]).collect()
    rows = sorted(corpus, key=order)
    want = [(d, *x) for (d, _), x in zip(rows, brute.removed(rows, length), strict=True)]
    assert sorted(((r.record.doc_id, r.n_words, r.n_removed, r.kept) for r in out), key=repr) == sorted(want, key=repr)
    assert all(r.record.kept == "clash" and r.record.lang == "en" for r in out)


def test_untouched_texts_may_stay_as_they_are(docs, corpus, staging):
    out = sd.remove_repeats(docs, staging=staging, as_is=True).collect()
    texts = {d: t for d, t in corpus}
    assert any(r.n_removed for r in out)
    assert all(r.kept == texts[r.record.doc_id] for r in out if not r.n_removed)


def test_empty_table(empty, staging):
    assert sd.remove_repeats(empty, staging=staging).count() == 0


def test_levels_and_messages():
    assert sd.levels(20) == [10, 20] and sd.levels(7) == [7] and sd.levels(50) == [25, 50] and sd.levels(40) == [10, 20, 40]
    at = np.array([0, 3, 70_000, 1 << 31])
    h = np.array([1, 1 << 39, 5, (1 << 40) - 1], np.uint64)
    back = sd.unpack(sd.pack(at, h, 5), 5)
    assert back[0].tolist() == at.tolist() and back[1].tolist() == h.tolist()


def test_finding_runs_holds_little_memory():
    """A task finding runs in 30 MB of texts holds under 64 MB of arrays; with 8 MB units it held 150 MB."""
    import tracemalloc

    import pyarrow as pa

    from portolan.llm.tables import ROW

    rng = np.random.default_rng(7)
    texts = [" ".join(f"w{i}" for i in rng.integers(0, 5000, rng.integers(200, 900))) for _ in range(10_000)]
    ids = pa.array(range(len(texts)), pa.int64())
    batch = pa.RecordBatch.from_arrays([ids, ids, pa.array(texts)], [ROW, "doc_id", "text"])
    tracemalloc.start()
    try:
        sent = sum(len(b) for b in sd._shortest_runs(10, sd._Sender(64, 5, False))(iter([batch])))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert sent and peak < 64 << 20
