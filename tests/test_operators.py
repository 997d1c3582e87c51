import datetime as dt
import importlib
import math
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from portolan import operators as ops
from portolan.sinks import Staging


def tuples(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# ---------------------------------------------------------------- columns


def test_rename_is_strict(spark):
    df = spark.createDataFrame([(1, 2)], "cicid int, other int")
    assert ops.rename_columns(df, {"cicid": "record_id"}).columns == ["record_id", "other"]
    with pytest.raises(ValueError, match="ccid"):
        ops.rename_columns(df, {"ccid": "record_id"})


def test_drop_ignores_absent_columns(spark):
    df = spark.createDataFrame([(0, 1)], "_c0 int, a int")
    assert ops.drop_columns(df, ["_c0", "not there"]).columns == ["a"]


def test_doubles_to_int_touches_doubles_only(spark):
    df = spark.createDataFrame([(1.5, "1.5", 7, 3e9)], "a double, s string, n bigint, `w x` double")
    out = ops.doubles_to_int(df, ["w x"])
    assert out.dtypes == [("a", "int"), ("s", "string"), ("n", "bigint"), ("w x", "bigint")]
    assert out.first() == (1, "1.5", 7, 3000000000)


def test_drop_sparse(spark):
    rows = [(i, None if i else "x", math.nan if i > 1 else 1.0, "y" if i % 2 else None) for i in range(20)]
    df = spark.createDataFrame(rows, "id int, empty string, nans double, half string")
    # 95 % and 90 % missing; the limit itself is kept
    assert ops.sparse_columns(df) == ["empty"]
    assert ops.drop_sparse(df, 0.8).columns == ["id", "half"]
    assert ops.sparse_columns(df.where("id < 0")) == []


# ---------------------------------------------------------------- rows and profiles


HOLEY = [
    (1, 1.0, "a", dt.date(2020, 1, 1)),
    (2, math.nan, "b", None),
    (3, None, None, dt.date(2020, 1, 3)),
    (4, 4.0, None, dt.date(2020, 1, 4)),
]
HOLEY_SCHEMA = "id int, `v 1` double, s string, d date"


@pytest.mark.parametrize("subset", [["v 1"], ["s"], ["d"], ["v 1", "s", "d"], ["id"]])
def test_drop_missing_equals_dropna(spark, subset):
    df = spark.createDataFrame(HOLEY, HOLEY_SCHEMA)
    # NaN differs from itself, hence the text form
    assert repr(tuples(ops.drop_missing(df, subset))) == repr(tuples(df.dropna(subset=subset)))


def test_null_profile_and_percent(spark):
    df = spark.createDataFrame(HOLEY, HOLEY_SCHEMA)
    assert ops.null_profile(df).first() == (0, 2, 2, 1)
    assert tuples(ops.null_percent(df)) == [("d", 1, 25.0), ("s", 2, 50.0), ("v 1", 2, 50.0)]
    assert ("id", 0, 0.0) in tuples(ops.null_percent(df, only_missing=False))
    assert tuples(ops.null_percent(df.where("id < 0"))) == []


def test_losses(spark):
    rows = [(1, "a"), (1, None), (1, "b"), (2, None), (None, "c"), (None, "d")]
    df = spark.createDataFrame(rows, "k int, s string")
    assert ops.dropna_loss(df, ["s"]).first() == (6, 4, 2)
    assert ops.dedup_loss(df, ["k"]).first() == (6, 3, 3)
    # two nulls go, then one of (1,a),(1,b) and one of the null keys
    assert ops.cleaning_loss(df, ["s"], ["k"]).first() == (6, 2, 2, 2)
    assert ops.cleaning_loss(df, [], ["k"]).first() == (6, 0, 3, 3)
    empty = df.where("k = 99")
    assert ops.cleaning_loss(empty, ["s"], ["k"]).first() == (0, 0, 0, 0)
    assert ops.dedup_loss(empty, ["k"]).first() == (0, 0, 0)


@pytest.mark.parametrize("partitions", [1, 5])
def test_key_counts(spark, partitions):
    rows = [("a", 1, 1.0), ("a", 1, None), ("b", None, None), ("b", None, None), (None, 2, 5.0), ("c", 3, float("nan")), (None, None, 4.0)]
    df = spark.createDataFrame(rows, "k string, l int, v double").repartition(partitions)
    counts = ops.key_counts(df, ["k", "l"], ["v"], {"filled": F.col("v").isNotNull().cast("long")})
    assert tuples(counts) == sorted(
        [(True, "a", 1, 2, 1, 1, 1), (True, "b", None, 2, 2, 0, 0), (False, None, None, 3, 1, 2, 3)], key=repr
    )
    loss = tuples(ops.counted_loss(counts, ["filled"]))
    assert loss == [(*tuples(ops.cleaning_loss(df, ["v"], ["k", "l"]))[0], 4)] == [(7, 4, 0, 3, 4)]
    assert tuples(ops.counted_loss(ops.key_counts(df.limit(0), ["k"]))) == [(0, 0, 0, 0)]
    # with NaN, so compared as text
    assert repr(tuples(ops.dedup_rare(df, ["k", "l"], rare=1.0, counts=counts))) == repr(tuples(ops.dedup(df, ["k", "l"])))


def test_counts_averages_distinct_preview(spark):
    df = spark.createDataFrame([("x", 1.0), ("x", 2.0), (None, 5.0), ("y", None)], "k string, v double")
    assert tuples(ops.row_counts({"t": df, "u": df.where("false")})) == [("t", 4), ("u", 0)]
    assert tuples(ops.average_by(df, "k", "v", "m")) == [("x", 1.5), ("y", None), (None, 5.0)]
    assert tuples(ops.distinct_values(df, "k")) == [("x",), ("y",), (None,)]
    assert [r.v for r in ops.preview(df, [F.col("v").desc()], 2).collect()] == [5.0, 2.0]


# ---------------------------------------------------------------- dedup


def brute_dedup(rows, width):
    def low(v):  # nulls first, NaN last
        return (v is not None, isinstance(v, float) and math.isnan(v), 0 if v is None else v)

    best = {}
    for r in rows:
        k = r[:width]
        if k not in best or [low(v) for v in r] < [low(v) for v in best[k]]:
            best[k] = r
    return sorted(best.values(), key=repr)


row = st.tuples(
    st.one_of(st.none(), st.integers(0, 3)),
    st.one_of(st.none(), st.sampled_from(["a", "b"])),
    st.one_of(st.none(), st.integers(0, 5)),
    st.one_of(st.none(), st.sampled_from(["p", "q", "r"])),
)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(row, min_size=1, max_size=40))
def test_dedup_against_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "a int, b string, c int, d string").repartition(3)
    want = brute_dedup(rows, 2)
    assert tuples(ops.dedup(df, ["a", "b"])) == want
    assert tuples(ops.dedup_rare(df, ["a", "b"], rare=1.0)) == want
    assert tuples(ops.dedup_rare(df, ["a", "b"], rare=0.0)) == want


def test_dedup_is_stable_and_idempotent(spark):
    df = spark.range(3000).selectExpr("id % 700 AS k", "cast(hash(id) AS string) AS v", "id")
    results = []
    for n in (1, 4, 17):
        spark.conf.set("spark.sql.shuffle.partitions", str(n))
        results.append(tuples(ops.dedup(df.repartition(n), ["k"])))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert results[0] == results[1] == results[2]
    once = ops.dedup(df, ["k"])
    assert tuples(ops.dedup(once, ["k"])) == tuples(once)


def test_dedup_with_a_key_that_holds_most_rows(spark):
    df = spark.range(20000).selectExpr("IF(id % 10 < 9, 0, id) AS k", "20000 - id AS v")
    want = sorted([(0, 2)] + [(i, 20000 - i) for i in range(9, 20000, 10)], key=repr)
    assert tuples(ops.dedup(df, ["k"])) == want
    assert tuples(ops.dedup_rare(df, ["k"], rare=1.0)) == want


def _sorts_before_shuffle(node, since_exchange=()):
    """Names of the nodes between a leaf and the first exchange above it, for every leaf that a Sort lies under."""
    name = node.nodeName()
    path = () if "Exchange" in name else (*since_exchange, name)
    children = node.children()
    if children.size() == 0:
        return [path] if any(n.startswith("Sort") for n in path) else []
    return [p for i in range(children.size()) for p in _sorts_before_shuffle(children.apply(i), path)]


def test_dedup_sorts_no_rows_before_they_are_dealt_by_key(spark, monkeypatch):
    module = importlib.import_module("portolan.operators.dedup")

    monkeypatch.setattr(module, "HEAVY_ROWS", 100)
    df = spark.range(3000).selectExpr("IF(id % 3 = 0, NULL, id % 500) AS k", "cast(hash(id) AS string) AS v", "id")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = ops.dedup(df.repartition(5), ["k"])
        assert _sorts_before_shuffle(out._jdf.queryExecution().executedPlan()) == []
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    rows = df.collect()
    want = {}
    for r in rows:
        if r.k not in want or (r.v, r.id) < want[r.k][1:]:
            want[r.k] = (r.k, r.v, r.id)
    assert tuples(out) == sorted(want.values(), key=repr)


def _reused_shuffles(node):
    """Columns of each shuffle that a plan reads more than once: reused exchanges that are no broadcast."""
    children = node.children()
    found = []
    if node.nodeName() == "ReusedExchange" and "Broadcast" not in node.child().nodeName():
        output = node.child().output()
        found.append(sorted(output.apply(i).name() for i in range(output.size())))
    return found + [n for i in range(children.size()) for n in _reused_shuffles(children.apply(i))]


def test_dedup_reads_the_shuffle_of_whole_rows_once(spark, monkeypatch):
    module = importlib.import_module("portolan.operators.dedup")

    monkeypatch.setattr(module, "HEAVY_ROWS", 100)
    df = spark.range(0, 3000, 1, 5).selectExpr("IF(id % 3 = 0, NULL, id % 500) AS k", "cast(hash(id) AS string) AS v", "id")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = ops.dedup(df, ["k"])
        # Only the counts of keys may be read twice, not whole rows.
        assert all("v" not in names for names in _reused_shuffles(out._jdf.queryExecution().executedPlan()))
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    want = {}
    for r in df.collect():
        if r.k not in want or (r.v, r.id) < want[r.k][1:]:
            want[r.k] = (r.k, r.v, r.id)
    assert tuples(out) == sorted(want.values(), key=repr)


def test_dedup_by_all_columns_and_by_given_order(spark):
    df = spark.createDataFrame([(1, 2), (1, 2), (1, 3)], "a int, b int")
    assert tuples(ops.dedup(df, ["a", "b"])) == [(1, 2), (1, 3)]
    assert tuples(ops.dedup(df, ["a"], [F.col("b").desc()])) == [(1, 3)]


def test_rare_dedup_falls_back_when_keys_cannot_be_broadcast(spark):
    df = spark.range(500).selectExpr("id % 100 AS k", "id")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = ops.dedup_rare(df, ["k"], rare=1.0)
        assert tuples(out) == sorted(((i, i) for i in range(100)), key=repr)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


# ---------------------------------------------------------------- keys


def test_small_key_puts_null_last(spark):
    df = spark.createDataFrame([("b",), (None,), ("a",)], "v string")
    assert tuples(ops.dense_key_small(df, ["v"], "k")) == [("a", 0), ("b", 1), (None, 2)]
    assert dict(ops.dense_key_small(df, ["v"], "k").dtypes)["k"] == "bigint"


@pytest.mark.parametrize("partitions", ["1", "4", "17"])
def test_key_by_range_is_dense_and_ordered(spark, partitions):
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        # a third of all rows share the leading value, some have none
        df = spark.range(5000).selectExpr(
            "CASE WHEN id % 3 = 0 THEN 7 WHEN id % 11 = 0 THEN NULL ELSE id % 50 END AS a", "5000 - id AS b"
        )
        got = ops.dense_key_by_range(df, ["a", "b"], "k").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    ordered = sorted(got, key=lambda r: r.k)
    assert [r.k for r in ordered] == list(range(5000))
    keys = [(r.a is None, r.a or 0, r.b) for r in ordered]
    assert keys == sorted(keys)


def test_both_key_methods_agree(spark):
    df = Staging(spark).write(spark.range(2000).selectExpr("hash(id) AS a", "id AS b"), "rows")
    small = ops.add_dense_key(df, ["a", "b"], "k")
    large = ops.add_dense_key(df, ["a", "b"], "k", small_rows=10)
    assert tuples(small) == tuples(large)


def test_key_of_an_empty_table(spark):
    df = spark.range(0)
    assert ops.dense_key_by_range(df, ["id"], "k").collect() == []


# ---------------------------------------------------------------- lookup join


FACT = [(1, "a"), (2, "b"), (3, None), (4, "zz"), (5, "a")]
DIM = [("a", 0, "A"), ("b", 1, None), (None, 2, "none")]


@pytest.mark.parametrize("limit", [None, 0])
@pytest.mark.parametrize("null_safe", [False, True])
def test_lookup_join(spark, limit, null_safe):
    fact = spark.createDataFrame(FACT, "id int, v string")
    dim = spark.createDataFrame(DIM, "v string, k int, name string")
    got = ops.lookup_join(fact, dim, {"v": "v"}, null_safe, limit)
    assert got.columns == ["id", "v", "k", "name"]
    of_null = (2, "none") if null_safe else (None, None)
    assert tuples(got) == [
        (1, "a", 0, "A"),
        (2, "b", 1, None),
        (3, None, *of_null),
        (4, "zz", None, None),
        (5, "a", 0, "A"),
    ]


def test_shuffled_lookup_spreads_frequent_keys(spark):
    """A key, and null, with a third of the rows each: same rows as a plain join."""
    fact = spark.range(6000).selectExpr(
        "id", "CASE WHEN id % 3 = 0 THEN 1 WHEN id % 3 = 1 THEN NULL ELSE id % 40 END AS a", "id % 2 AS b"
    )
    dim = spark.range(80).selectExpr("id div 2 AS x", "id % 2 AS y", "id * 10 AS k")
    plain = fact.join(dim, (F.col("a") == F.col("x")) & (F.col("b") == F.col("y")), "left").drop("x", "y")
    split = ops.lookup_join(fact, dim, {"a": "x", "b": "y"}, limit=0)
    assert tuples(split) == tuples(plain)
    dim = dim.unionByName(spark.sql("SELECT NULL AS x, 0 AS y, -1 AS k"))
    plain = fact.join(dim, F.col("a").eqNullSafe(F.col("x")) & (F.col("b") == F.col("y")), "left").drop("x", "y")
    split = ops.lookup_join(fact, dim, {"a": "x", "b": "y"}, null_safe=True, limit=0)
    assert tuples(split) == tuples(plain)


def test_shuffled_lookup_without_frequent_keys(spark):
    fact = spark.range(1000).selectExpr("id", "id AS a")
    dim = spark.range(0, 2000, 2).selectExpr("id AS a", "id + 1 AS k")
    got = ops.lookup_join(fact, dim, {"a": "a"}, limit=0)
    assert tuples(got) == tuples(fact.join(dim, "a", "left").select("id", "a", "k"))


def test_size_check(spark):
    df = spark.createDataFrame([("x" * 100,), ("y" * 50,), (None,)], "s string")
    assert ops.measured_bytes(df) == 150 + 3 * 24
    assert ops.fits_broadcast(df, 1000) and not ops.fits_broadcast(df, 100)
    assert not ops.fits_broadcast(df, 0) and not ops.fits_broadcast(df, -1)
    nested = spark.sql("SELECT array(1, 2, 3) AS a, map('k', 1) AS m")
    assert ops.measured_bytes(nested) > 32
    for text, size in [("10485760b", 10485760), ("10MB", 10485760), ("1g", 1 << 30), ("-1", -1)]:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", text)
        assert ops.broadcast_limit(spark) == size
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


# ---------------------------------------------------------------- quality


def test_checks(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (None, "c"), (None, "d")], "k int, s string")
    good = spark.createDataFrame([(1, "a")], "k int, s string")
    assert tuples(ops.check_not_empty({"t": df, "e": df.where("false")})) == [
        ("e", 0, "FAIL"),
        ("t", 4, "PASS"),
    ]
    assert tuples(ops.check_unique({"t": (df, ["k"]), "u": (df, ["k", "s"])})) == [
        ("t", "k", 2, 2, "FAIL"),
        ("u", "k,s", 0, 0, "PASS"),
    ]
    nulls = ops.check_not_null({"t": (df, ["k", "s"]), "g": (good, ["k"])})
    assert tuples(nulls) == [("g", "k", 0, "PASS"), ("t", "k", 2, "FAIL"), ("t", "s", 1, "FAIL")]
    with pytest.raises(ValueError, match="null_values"):
        ops.raise_on_failure(nulls)
    ok = ops.check_not_null({"g": (good, ["k", "s"])})
    assert ops.raise_on_failure(ok) is ok


def test_unique_check_of_an_empty_table_passes(spark):
    assert ops.check_unique({"e": (spark.range(0), ["id"])}).first() == ("e", "id", 0, 0, "PASS")


@pytest.mark.parametrize("limit", [None, 0])
def test_lookup_is_the_same_at_every_size(spark, limit):
    fact = spark.sql("SELECT id, CAST(if(id % 3 > 0, 7, id) AS INT) AS k, map('a', id) AS m FROM range(300)").unionByName(
        spark.sql("SELECT -1L AS id, CAST(NULL AS INT) AS k, map('a', 1L) AS m")
    )
    dim = spark.createDataFrame([(7, "seven"), (0, "zero"), (None, "none"), (None, "none again")], "key int, name string")
    out = ops.lookup_join(fact, dim, {"k": "key"}, limit=limit)
    names = {r.id: r.name for r in out.collect()}
    assert out.count() == 301 and names[1] == "seven" and names[0] == "zero" and names[3] is None and names[-1] is None
    with pytest.raises(ValueError, match="more than once"):
        ops.lookup_join(fact, dim, {"k": "key"}, null_safe=True, limit=limit)
    with pytest.raises(ValueError, match="more than once"):
        ops.lookup_join(fact, dim.union(dim), {"k": "key"}, limit=limit)
    with pytest.raises(ValueError, match="both have"):
        ops.lookup_join(fact, dim.withColumnRenamed("name", "M"), {"k": "key"}, limit=limit)
    only_map = fact.select("m", "k")
    assert ops.lookup_join(only_map, dim, {"k": "key"}, limit=limit).count() == 301


def test_references(spark):
    fact = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    dim = spark.createDataFrame([(2,), (None,)], "d int")
    out = ops.check_references({("f", "k"): (fact, dim, "d")})
    assert [tuple(r) for r in out.collect()] == [("f", "k", 2, "FAIL")]


def test_averages_do_not_depend_on_the_order_of_rows(spark):
    rng = random.Random(3)
    values = [rng.uniform(-1, 1) * 2.0 ** rng.randint(-60, 60) for _ in range(3000)] + [5e-324, -5e-324, 2.0**-1022, 1024.0, 1023.9999999999999]
    rows = [(i % 7, v) for i, v in enumerate(values)]
    rows += [(7, v) for v in (0.1, 0.2, 0.3, None)] + [(8, None), (9, 0.0), (9, -0.0), (10, math.inf), (10, 1.0)]
    rows += [(11, math.inf), (11, -math.inf), (12, math.nan), (13, 1e16), (13, 1.0), (13, -1e16), (14, 5e-324), (None, 2.5), (15, 1e308), (15, -1e308), (15, 8.0)]
    seen = set()
    for n in (1, 4, 17):
        rng.shuffle(rows)
        df = spark.createDataFrame(rows, "k int, v double").repartition(n)
        out = {r.k: r.mean for r in ops.average_by(df, "k", "v", "mean").collect()}
        seen.add(tuple(sorted((str(k), repr(v)) for k, v in out.items())))
    assert len(seen) == 1
    for k in (*range(8), 9, 13, 14, 15, None):
        mine = [v for g, v in rows if g == k and v is not None]
        assert out[k] == math.fsum(mine) / len(mine), k
    assert out[8] is None and out[10] == math.inf and math.isnan(out[11]) and math.isnan(out[12])


def test_weighted_averages(spark):
    df = spark.createDataFrame([("a", 0.1, 3), ("a", 0.7, 1), ("a", None, 9), ("a", 5.0, None), ("b", 2.0, 0)], "k string, v double, n long")
    out = ops.exact_average(df, ["k"], F.col("v"), "mean", F.col("n"))
    assert sorted(map(tuple, out.collect())) == [("a", math.fsum([0.1 * 3, 0.7]) / 4), ("b", None)]
    assert ops.exact_average(df.limit(0), [], F.col("v"), "mean").collect()[0].mean is None
