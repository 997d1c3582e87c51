import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from portolan.llm import near_dedup
from portolan.llm.tables import components
from tests.llm import brute
from tests.llm.conftest import frame, prose


@pytest.mark.parametrize("length", [4, 5])
def test_equals_all_pairs(docs, corpus, staging, length):
    out = near_dedup.near_duplicates(docs, shingle_words=length, percent=80, staging=staging).collect()
    want = brute.components(corpus, length)
    got = sorted(((r.doc_id is None, r.doc_id, r.n_shingles, r.component_id, r.kept) for r in out), key=repr)
    assert got == sorted(((d is None, d, n, c, d == c) for (d, _), (n, c) in zip(corpus, want, strict=True)), key=repr)
    firsts = [r for r in out if r.first_row]
    assert len({r.component_id for r in firsts}) == len(firsts) == len({(c, d) if n == 0 else c for (d, _), (n, c) in zip(corpus, want, strict=True)})


def test_blocks_of_large_groups_lose_no_link(spark, staging, monkeypatch):
    """A chain of near copies over many blocks, of which neighbours alone are linked."""
    monkeypatch.setattr(near_dedup, "GROUP_BLOCK", 8)
    monkeypatch.setattr(near_dedup, "BUCKET_BLOCK", 8)
    rng = random.Random(3)
    w, rows = prose(rng, 100, 5000).split(), []
    for i in range(60):
        rows.append((i, " ".join(w)))
        w[rng.randrange(len(w))] = f"new{i}"
    out = near_dedup.near_duplicates(frame(spark, rows), shingle_words=4, percent=80, staging=staging).collect()
    want = brute.components(rows, 4)
    assert {r.doc_id: r.component_id for r in out} == {d: c for (d, _), (_, c) in zip(rows, want, strict=True)}


def test_empty_table(empty, staging):
    assert near_dedup.near_duplicates(empty, staging=staging).count() == 0


def test_every_pair_within_the_radius_shares_a_key():
    rng = np.random.default_rng(1)
    one = rng.integers(0, 1 << 16, (200, near_dedup.VALUES), dtype=np.uint16)
    other = one.copy()
    for row in other:
        spots = rng.choice(near_dedup.VALUES, near_dedup.RADIUS, replace=False)
        row[spots] ^= rng.integers(1, 1 << 16, len(spots), dtype=np.uint16)
    a, b = near_dedup.lookup_keys(one), near_dedup.lookup_keys(other)
    assert (a == b).any(axis=1).all()
    assert not (near_dedup.lookup_keys(one[:100]) == near_dedup.lookup_keys(one[100:])).any()


def test_the_chance_of_a_miss_is_the_one_that_is_stated():
    miss = sum(math.comb(near_dedup.VALUES, k) * 0.2**k * 0.8 ** (near_dedup.VALUES - k) for k in range(near_dedup.RADIUS + 1, near_dedup.VALUES + 1))
    assert f"{miss * 1e6:.1f} of a million pairs" in " ".join(near_dedup.__doc__.split())


def test_links_survive_rows_in_another_order(spark, docs, corpus, staging, monkeypatch):
    """Groups arrive in another order whenever a task runs, as they do when executors fetch from each other."""
    for name in ("_bucket_edges", "_links"):
        monkeypatch.setattr(near_dedup, name, in_any_order(getattr(near_dedup, name)))
    out = near_dedup.near_duplicates(docs, shingle_words=4, percent=80, staging=staging).collect()
    want = brute.components(corpus, 4)
    assert sorted(((r.doc_id, r.component_id) for r in out), key=repr) == sorted(((d, c) for (d, _), (_, c) in zip(corpus, want, strict=True)), key=repr)


def in_any_order(make):
    def made(percent):
        work = make(percent)

        def run(table):
            return work(table.take(np.random.default_rng().permutation(len(table))))

        return run

    return made


def test_edges_do_not_depend_on_the_order_of_names():
    def edges(names):
        tree = near_dedup.Union(len(names))
        for one, other in ((b"b", b"d"), (b"d", b"c"), (b"a", b"e")):
            tree.join(names.index(one), names.index(other))
        return sorted(map(tuple, zip(*near_dedup._edge_table(names, tree).to_pydict().values(), strict=True)))

    names = [b"a", b"b", b"c", b"d", b"e", b"f"]
    for seed in range(20):
        assert edges(random.Random(seed).sample(names, 6)) == [(b"a", b"e"), (b"b", b"c"), (b"b", b"d")]


def test_components_read_their_edges_once(spark, staging):
    """Edges that are turned round whenever they are evaluated."""
    turn = F.udf(lambda x: random.SystemRandom().random() < 0.5, "boolean").asNondeterministic()
    pairs = spark.range(0, 400, 2, 4).select(F.col("id").alias("x"), (F.col("id") + 1).alias("y"), turn("id").alias("t"))
    edges = pairs.select(F.when(F.col("t"), F.col("x")).otherwise(F.col("y")).alias("a"), F.when(F.col("t"), F.col("y")).otherwise(F.col("x")).alias("b"))
    found = {r.node: r.root for r in components(edges, staging).collect()}
    assert found == {i: i - i % 2 for i in range(400)}
