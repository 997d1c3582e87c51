import random

import numpy as np
import pytest

from portolan.llm import decontaminate as dc
from tests.llm import brute
from tests.llm.conftest import frame, prose


@pytest.fixture
def bench(spark):
    rng = random.Random(11)
    items = [(i, prose(rng, n, 3000)) for i, n in enumerate([3, 5, 9, 16, 17, 24, 33, 48, 60, 300])]
    items += [(20, items[5][1]), (21, ""), (22, None), (None, "no number at all here, none")]
    return items, spark.createDataFrame(items, "item_id long, text string")


def test_finds_what_brute_force_finds(spark, bench):
    items, table = bench
    rng, rows = random.Random(5), []
    for i in range(40):
        before, after = prose(rng, rng.randint(0, 40), 3000), prose(rng, rng.randint(0, 40), 3000)
        w = (rng.choice(items[2:10])[1]).split()
        for _ in range(rng.randint(0, 2)):
            w[rng.randrange(len(w))] = "edited"
        rows.append((i, " ".join([before, *(x.upper() if i % 3 else x for x in w), after])))
    rows += [(100, None), (101, ""), (102, items[3][1]), (103, prose(rng, 4000, 3000)), (104, items[0][1]), (105, "w1")]
    out = {r.doc_id: r for r in dc.find_leaks(frame(spark, rows), table).collect()}
    searched = [(i, t) for i, t in items if i is not None and t]
    for d, text in rows:
        want = {i: s for i, s in brute.leaks(text, searched).items() if s >= 0.8}
        got = {x.item_id: x.similarity for x in out[d].leaks}
        # windows just beyond the threshold and the radius may differ; none clearly similar may be missed
        assert all(i in got for i, s in want.items() if s >= 0.85), (d, want, got)
        assert all(s == pytest.approx(want[i]) for i, s in got.items() if i in want)
        assert set(got) <= set(want)
        assert [x.similarity for x in out[d].leaks] == sorted(got.values(), reverse=True)
    assert {x.item_id for x in out[102].leaks} == {3} and not out[103].leaks


def test_batches_of_items_and_extra_columns(spark, bench, docs, empty, monkeypatch):
    items, table = bench
    whole = {r.doc_id: r.leaks for r in dc.find_leaks(docs, table).drop("record").collect()}
    monkeypatch.setattr(dc, "ITEM_BATCH", 4)
    parts = {r.doc_id: r.leaks for r in dc.find_leaks(docs, table).collect()}
    assert {d: sorted(x.item_id for x in v) for d, v in whole.items()} == {d: sorted(x.item_id for x in v) for d, v in parts.items()}
    assert dc.find_leaks(empty, table).count() == 0
    assert all(not r.leaks for r in dc.find_leaks(docs, table.where("item_id > 99")).collect())


def test_index_finds_every_fingerprint_within_the_radius(monkeypatch):
    rng = np.random.default_rng(2)
    prints = rng.integers(0, 1 << 63, 100, dtype=np.uint64)
    probes = prints.copy()
    for i in range(len(probes)):
        for b in rng.choice(64, dc.RADIUS, replace=False):
            probes[i] ^= np.uint64(1) << np.uint64(b)
    far = probes ^ np.uint64((1 << 40) - 1)
    for few in (0, 1000):
        monkeypatch.setattr(dc, "FEW", few)
        index = dc.Index(20, prints, range(100))
        place, item = index.near(np.concatenate((probes, far)))
        close = np.bitwise_count(np.concatenate((probes, far))[:, None] ^ prints) <= dc.RADIUS
        assert sorted(zip(place.tolist(), item.tolist(), strict=True)) == [tuple(x) for x in np.argwhere(close).tolist()]


def test_running_sums_count_bits():
    h = np.random.default_rng(3).integers(0, 1 << 63, 700, dtype=np.uint64)
    for size in (3, 20, 300):
        runs = dc.words.runs(h, 3)
        bits = np.unpackbits(runs.view(np.uint8)).reshape(-1, 64)
        want = [np.packbits(bits[i : i + size - 2].sum(axis=0) > (size - 2) // 2).view(np.uint64)[0] for i in range(0, 701 - size, 4)]
        assert dc.fingerprints(h, size, 4).tolist() == want


@pytest.mark.parametrize("batch", [5000, 1])
def test_copies_of_an_item_do_not_hide_an_edit(spark, monkeypatch, batch):
    rng = random.Random(21)
    ids = {1: [0], 2: [1, 2], 9: list(range(3, 12))}
    texts = {n: prose(rng, 60, 100_000) for n in ids}
    table = spark.createDataFrame([(i, texts[n]) for n in ids for i in ids[n]], "item_id long, text string")
    rows = []
    for n in ids:
        w = texts[n].split()
        w[30] = "edited"
        rows.append((n, " ".join([prose(rng, 25, 100_000), *w, prose(rng, 25, 100_000)])))
    monkeypatch.setattr(dc, "ITEM_BATCH", batch)
    for r in dc.find_leaks(frame(spark, rows), table).collect():
        assert [x.item_id for x in r.leaks] == ids[r.doc_id]
        assert all(x.similarity == pytest.approx(51 / 61) for x in r.leaks)


def leaking(rng, item, k):
    """An item with ``k`` words changed, lost or added."""
    w = item.split()
    for _ in range(k):
        at = rng.choice([0, len(w) - 1, rng.randrange(len(w))])
        w[at : at + rng.choice([1, 1, 0])] = rng.choice([["edited"], ["edited"], []])
    return " ".join(w)


def test_every_leak_is_found_wherever_it_lies(monkeypatch):
    rng = random.Random(31)
    items = [(i, prose(rng, n, 3000)) for i, n in enumerate([2, 4, 5, 7, 15, 16, 23, 24, 31, 40, 59, 60, 100, 257])]
    items += [(50, items[9][1] + " and more"), (51, items[9][1]), (52, "on and " * 15)]
    texts = [items[13][1], "on and " * 40, "", None]
    for i in range(400):
        w = leaking(rng, rng.choice(items)[1], rng.randint(0, 3))
        # Begins, ends or fills its text, or lies within it.
        texts.append(" ".join([prose(rng, rng.randint(1, 30), 3000) * rng.randint(0, 1), w, prose(rng, rng.randint(1, 30), 3000) * rng.randint(0, 1)]))
    bench = dc.Benchmark(items)
    for limit in (1 << 18, 1):  # all in one block, and each text at the end of its own
        monkeypatch.setattr(dc, "SEARCH_BYTES", limit)
        found = list(bench.search(dc.pa.array(texts), 0.8))
        for text, hits in zip(texts, found, strict=True):
            want = {i: s for i, s in plain_leaks(text or "", items).items() if s >= 0.8}
            assert {x["item_id"]: x["similarity"] for x in hits} == want
            for x in hits:
                w = brute.words(brute.lower(text))[x["first_word"] :][: x["n_words"]]
                assert x["similarity"] == brute.similarity(dc.Counter(brute.runs(w)), dc.Counter(brute.runs(brute.words(items_by(items, x)))), {})


def items_by(items, hit):
    return brute.lower(dict(items)[hit["item_id"]])


def plain_leaks(text, items):
    out = {}
    for item in items:  # one at a time, so that no weights are shared
        out |= brute.leaks(text, [item])
    return out
