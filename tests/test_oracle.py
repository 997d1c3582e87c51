"""Every registered query against its SQL, and the shape of the plans."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
from portolan import operators as ops
from portolan import plans
from portolan.plans.etl import loss_report
from tests import compare
from workload import standins
from workload.oracle import ORACLE as SQL
from workload.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry_module.queries()) and set(SQL) <= set(entry_module.oracle_sql())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, con, name):
    assert compare.differences(QUERIES[name](spark, SF), SQL[name], con) == []


def test_entry(spark):
    df = entry_module.entry(spark)
    assert df.columns == [
        "country_name", "arrival_year", "visa_type_key", "visatype", "arrivals", "average_temperature",
    ]
    assert df.agg(F.sum("arrivals")).first()[0] == 4526


# ---------------------------------------------------------------- plans


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_and_no_cartesian_product_anywhere(spark):
    for name, query in QUERIES.items():
        plan = physical(query(spark, SF))
        for word in ("EvalPython", "MapInPandas", "FlatMapGroups", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert word not in plan, (name, word)


def test_missing_value_filter_reaches_the_scan(spark):
    orders = standins.table(spark, SF, "orders")
    plan = physical(ops.drop_missing(orders, ["o_totalprice", "o_orderpriority"]).select("o_orderkey"))
    assert "IsNotNull(o_totalprice)" in plan and "IsNotNull(o_orderpriority)" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double,o_orderpriority:string>" in plan


def test_date_filter_is_not_evaluated_in_python(spark):
    cleaned = plans.clean_arrivals(standins.arrivals(spark, SF)).where("arrdate >= DATE'1999-01-01'")
    assert "Python" not in physical(cleaned)


def test_dedup_limits_each_key_before_the_shuffle(spark):
    plan = physical(ops.dedup(standins.table(spark, SF, "lineitem"), ["l_orderkey", "l_linenumber"]))
    before, after = plan.split("Exchange hashpartitioning")
    assert "WindowGroupLimit" in after and "Partial" in after
    assert "WindowGroupLimit" in before and "Final" in before


def test_rare_dedup_ranks_only_rows_of_repeated_keys(spark):
    lines = standins.table(spark, SF, "lineitem")
    df = ops.dedup_rare(lines, ["l_partkey", "l_shipdate"])
    plan = physical(df)
    # this way, ranking everything, and the plain operator agree
    others = [ops.dedup_rare(lines, ["l_partkey", "l_shipdate"], rare=0.0), ops.dedup(lines, ["l_partkey", "l_shipdate"])]
    assert df.count() < lines.count()
    assert all(df.exceptAll(x).isEmpty() and x.exceptAll(df).isEmpty() for x in others)
    assert "LeftAnti" in plan and "LeftSemi" in plan and plan.count("Exchange hashpartitioning") == 1


def test_small_dimension_is_broadcast_and_the_fact_is_not_shuffled(spark):
    plan = physical(QUERIES["fact_dim_key"](spark, SF))
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_large_dimension_is_joined_by_shuffle(spark):
    plan = physical(QUERIES["fact_dim_key_shuffled"](spark, SF))
    join = plan.index("SortMergeJoin")
    # both sides arrive hashed on the key and the piece
    assert plan[join:].count("__piece") + plan[join:].count("__fact_piece") > 2


def test_codes_are_distinct_before_they_meet_the_mapping(spark):
    plan = physical(QUERIES["country_dim"](spark, SF))
    # the aggregate is below the join, i.e. further down in the printed tree
    assert plan.index("BroadcastHashJoin") < plan.index("HashAggregate")


def test_calendar_filter_prunes_folders(spark):
    plan = physical(QUERIES["partitioned_roundtrip"](spark, SF))
    assert "PartitionFilters: [isnotnull(arrival_year" in plan


def test_losses_read_each_source_once(spark):
    plan = physical(loss_report(*sources_of(spark)[:3]))
    assert plan.count("Scan parquet") == 3


def test_counting_reads_no_column(spark):
    assert "ReadSchema: struct<>" in physical(ops.row_counts({"t": standins.table(spark, SF, "lineitem")}))


# ---------------------------------------------------------------- properties


def sources_of(spark):
    return [f(spark, SF) for f in (standins.arrivals, standins.demographics, standins.temperature, standins.mapping)]


def test_star_does_not_depend_on_partitioning(spark, tmp_path):
    results = []
    for n in ("1", "4", "17"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        try:
            arrivals, *rest = sources_of(spark)
            star = plans.build_star(arrivals.repartition(int(n)), *rest, str(tmp_path / n))
            results.append({k: sorted(map(repr, df.collect())) for k, df in star.named().items()})
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert results[0] == results[1] == results[2]


def test_losses_equal_the_rows_that_cleaning_leaves(spark):
    arrivals, demographics, temperature, _ = sources_of(spark)
    left = {
        "arrivals": plans.clean_arrivals(arrivals).count(),
        "demographics": plans.clean_demographics(demographics).count(),
        "temperature": plans.clean_temperature(temperature).count(),
    }
    for r in loss_report(arrivals, demographics, temperature).collect():
        assert r.after == left[r.source]
        assert r.before == r.after + r.dropped_missing + r.dropped_duplicates
        assert (r.nulled_keys > 0) == (r.source == "arrivals")


def test_fact_keeps_every_record_once(spark):
    fact = QUERIES["star_fact"](spark, SF)
    assert fact.count() == fact.select("record_id").distinct().count() == 4526
