"""op12 and op13 against brute force, the threshold index and the forest by themselves."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from portolan.llm import blocks, negatives, neighbours
from portolan.llm.queries import ORACLE, QUERIES
from tests import compare

SF = "/root/testdata/sf0.001"


def key(i):
    return (i is None, i or 0)


def mined(rows, k_pos=5, k_neg=10, low=30, high=90):
    """rows: (vec_id, vector, label) with every row one of its own."""
    live = [(i, v, l) for i, v, l in rows if l is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    ints = [[math.floor(256 * x) for x in v] for _, v, _ in live]
    out = []
    for a, (ai, _, al) in enumerate(live):
        if ai is None or ai % 100:
            continue
        scored = [(sum(x * y for x, y in zip(ints[a], ints[b])), live[b][0], live[b][2]) for b in range(len(live)) if b != a]
        scored.sort(key=lambda s: (-s[0], key(s[1])))
        for p, pi, _ in [s for s in scored if s[2] == al][:k_pos]:
            window = [s for s in scored if s[2] != al and low * p <= 100 * s[0] <= high * p]
            out += [(ai, pi, rank, n, p, s) for rank, (s, n, _) in enumerate(window[:k_neg], 1)]
    return sorted(out, key=repr)


def vectors(rng, n, width=24, labels=4):
    centres = rng.normal(size=(labels * 2, width))
    rows = []
    for i in range(n):
        v = centres[rng.integers(len(centres))] * rng.random() + rng.normal(size=width) * rng.choice([0.1, 1.0])
        rows.append((i * 10, [float(np.float32(x)) for x in v], int(rng.integers(labels))))
    return rows


def table(spark, rows, partitions=4):
    data = [(i, v, l, "clash", 1) for i, v, l in rows]
    return spark.createDataFrame(data, "vec_id long, embedding array<float>, label int, score string, rank int").repartition(partitions)


@pytest.fixture
def rows():
    rng = np.random.default_rng(5)
    out = vectors(rng, 300)
    copy = out[7][1]
    out += [(5000 + i, copy, i % 3) for i in range(40)]  # ties over labels
    out += [out[0], out[0], out[10]]  # repeated rows, anchors among them
    out += [
        (9000, None, 1), (9100, [], 1), (9200, [1.0, None], 1), (9300, [float("nan")] * 3, 1), (9400, [float("inf")], 2), (9500, [0.0] * 24, 2),
        (9600, [1.0, 2.0], 3), (9700, out[3][1], None), (None, out[3][1], 2), (9800, [-x for x in out[4][1]], 9), (9900, out[4][1], 9), (10000, [1.0] * 30, 0),
    ]
    return out


def got(df):
    return sorted((tuple(r) for r in df.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()), key=repr)


def test_negatives_equal_brute_force(spark, rows, staging):
    df = negatives.mine(table(spark, rows), F.col("vec_id") % 100 == 0, staging=staging)
    assert got(df) == mined(rows)


def test_negatives_over_many_blocks(spark, rows, staging, monkeypatch):
    small = lambda *a: blocks.meet(*a, rows_a_block=40, queries_a_block=7)
    monkeypatch.setattr(negatives, "meet", small)
    monkeypatch.setattr(negatives, "AT_ONCE", 3)
    df = negatives.mine(table(spark, rows), F.col("vec_id") % 100 == 0, positives=3, negatives=4, low=10, high=95, staging=staging)
    assert got(df) == mined(rows, 3, 4, 10, 95)


def test_few_rows_and_empty_tables(spark, rows, staging):
    anchor = F.col("vec_id") % 100 == 0
    for some in ([], rows[:1], [(100, [1.0], 1), (200, [0.5], 1)], [(100, [1.0, 1.0], 1), (201, [1.0, 0.5], 1), (301, [0.5, 0.5], 2)]):
        assert got(negatives.mine(table(spark, some, 1), anchor, staging=staging)) == mined(some)


def test_large_components_are_exact(spark, staging):
    rng = np.random.default_rng(1)
    some = [(i * 50, [float(np.float32(x * 1e5)) for x in rng.normal(size=16)], i % 2) for i in range(40)]
    some.append((7, [1e30] * 16, 1))  # scores beyond what is exact: takes no part
    df = negatives.mine(table(spark, some), F.col("vec_id") % 100 == 0, staging=staging)
    assert got(df) == mined(some[:-1])


def test_registered_negatives(spark):
    con = compare.connect(SF)
    assert compare.differences(QUERIES["op12_hard_negatives"](spark, SF), ORACLE["op12_hard_negatives"], con) == []
    relabelled = [
        (r.vec_id, r.embedding, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label)
        for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    ]
    assert got(QUERIES["op12_hard_negatives"](spark, SF)) == mined(relabelled)


@pytest.mark.parametrize("share", [0.9, 0.6, 0.3, 0.0, -1.0, -np.inf])
def test_threshold_index(share):
    rng = np.random.default_rng(2)
    x = np.floor(rng.normal(size=(500, 37)) * rng.random(37) * 300)
    y = np.floor(rng.normal(size=(20, 37)) * 300)
    index, exact = negatives.ThresholdIndex(x), (y @ x.T).astype(np.int64)
    t = np.sort(exact, 1)[:, -1] * share if np.isfinite(share) else np.full(20, -np.inf)
    q, r, s = index.search(y, t)
    want = exact >= t[:, None]
    assert len(q) == want.sum() and want[q, r].all() and (exact[q, r] == s).all()


def test_index_leaves_out_what_cannot_reach_the_threshold(monkeypatch):
    rng = np.random.default_rng(2)
    x = np.floor(rng.normal(size=(400, 64)) * 32)
    index, sizes = negatives.ThresholdIndex(x), []
    monkeypatch.setattr(index, "_bound", lambda score, *a: sizes.append(score.shape[1]) or negatives.ThresholdIndex._bound(index, score, *a))
    q, r, s = index.search(x[:3], 0.9 * (x[:3] ** 2).sum(1))
    assert {(int(a), int(b)) for a, b in zip(q, r)} == {(0, 0), (1, 1), (2, 2)} and sizes[-1] < 120


# ---------------------------------------------------------------- nearest neighbours


def nearest(rows, k):
    live = [(i, np.array(v, float)) for i, v, _ in rows if v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    width = max((len(v) for _, v in live), default=0)
    m = np.array([np.pad(v, (0, width - len(v))) for _, v in live])
    out = []
    for a, (ai, _) in enumerate(live):
        if ai is None or ai % 20:
            continue
        scores = (m * m[a]).sum(1)
        order = sorted((b for b in range(len(live)) if b != a), key=lambda b: (-scores[b], key(live[b][0])))
        out += [(ai, rank, live[b][0], float(scores[b])) for rank, b in enumerate(order[:k], 1)]
    return out


def found(df):
    return [tuple(r) for r in df.select("query_id", "rank", "vec_id", "score").collect()]


def test_neighbours_of_odd_rows(spark, rows, staging):
    """So few rows that the leaves visited hold them all: equal to brute force, ties and copies too."""
    few = rows[::3] + rows[-15:]
    df = neighbours.nearest(table(spark, few), F.col("vec_id") % 20 == 0, k=6, staging=staging)
    assert sorted(found(df), key=repr) == sorted(nearest(few, 6), key=repr)


def test_neighbours_of_few_and_no_rows(spark, staging):
    for some in ([], [(20, [1.0], 1)], [(20, [1.0, 2.0], 1), (21, [0.0, 0.0], 1), (22, [3.0], 1)]):
        df = neighbours.nearest(table(spark, some, 1), F.col("vec_id") % 20 == 0, staging=staging)
        assert sorted(found(df)) == sorted(nearest(some, 20))


def recall(got_rows, want_rows):
    a, b = {(q, i) for q, _, i, _ in got_rows}, {(q, i) for q, _, i, _ in want_rows}
    return len(a & b) / len(b)


def test_recall_over_many_blocks(spark, staging, monkeypatch):
    """Vectors of different norms without any structure, and a third of the rows equal."""
    rng = np.random.default_rng(9)
    some = [(i, [float(x) for x in rng.normal(size=64) * rng.uniform(0.5, 1.5)], 0) for i in range(4000)]
    some += [(10000 + i, some[1][1], 0) for i in range(2000)]
    small = lambda *a: blocks.meet(*a, rows_a_block=2500, queries_a_block=100)
    monkeypatch.setattr(neighbours, "meet", small)
    out = found(neighbours.nearest(table(spark, some), F.col("vec_id") % 20 == 0, staging=staging))
    want = nearest(some, 20)
    assert recall(out, want) >= 0.93
    exact = {(q, i): s for q, _, i, s in nearest(some, 6000)}
    assert all(abs(exact[q, i] - s) < 1e-9 for q, _, i, s in out)
    ranks = {}
    for q, rank, i, s in sorted(out):
        ranks.setdefault(q, []).append((rank, -s, i))
    assert all([r for r, _, _ in v] == list(range(1, 21)) and [x[1:] for x in v] == sorted(x[1:] for x in v) for v in ranks.values())


def test_registered_neighbours(spark):
    some = [(r.vec_id, r.embedding, 0) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    out = QUERIES["op13_nearest"](spark, SF)
    assert recall(found(out), nearest(some, 20)) >= 0.95 and len(found(out)) == len(nearest(some, 20))
    assert [t for _, t in out.dtypes] == ["bigint", "int", "bigint", "double"]


def test_leaves_come_in_the_order_of_one_queue():
    rng = np.random.default_rng(4)
    forest = neighbours.Forest(rng.normal(size=(1000, 8)), trees=5, leaf=50)
    assert sorted(np.concatenate(forest.leaves[: 1 << forest.depth]).tolist()) == list(range(1000))
    inner = (1 << forest.depth) - 1
    for margin in forest.margins(rng.normal(size=(20, 8))):
        priority = {}
        for tree in range(5):
            reach = {0: np.inf}
            for node in range(inner):
                m = margin[tree * inner + node]
                reach[2 * node + 1], reach[2 * node + 2] = min(reach[node], -m), min(reach[node], m)
            priority |= {tree * (inner + 1) + n - inner: reach[n] for n in range(inner, 2 * inner + 1)}
        visited = forest.visited(margin, 40)
        assert len(set(visited)) == 40 and [priority[x] for x in visited] == sorted(priority.values(), reverse=True)[:40]
