"""The registered queries: ``name -> (spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from portolan import functions as fx
from portolan import operators as ops
from portolan import plans, schemas, sinks, sources
from portolan.plans.etl import loss_report
from workload import standins
from workload.standins import table

Query = Callable[[SparkSession, str], DataFrame]

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]

LINE_KEY = ["l_orderkey", "l_linenumber"]


# ---------------------------------------------------------------- sources and sinks


def scan_parquet(spark, sf_dir):
    return sources.load_table(spark, f"{sf_dir}/nation.parquet")


def parquet_roundtrip(spark, sf_dir):
    path = sinks.Staging(spark).path("orders")
    sinks.write_parquet(table(spark, sf_dir, "orders"), path)
    return sources.load_table(spark, path)


def _named_parts(spark, sf_dir):
    return table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS code",
        "concat(p_name, ', ', p_brand, '; size \"', p_size, '\"') AS Name",
        "CASE WHEN p_type = 'SMALL' THEN NULL WHEN p_size % 10 = 0 THEN '' ELSE p_type END AS kind",
    )


def _csv_roundtrip(spark, sf_dir, sep):
    path = sinks.Staging(spark).path("csv")
    named = _named_parts(spark, sf_dir)
    sinks.write_csv(named, path, sep)
    return sources.read_csv(spark, path, named.schema, sep)


def csv_roundtrip(spark, sf_dir):
    return _csv_roundtrip(spark, sf_dir, ",")


def csv_semicolon_roundtrip(spark, sf_dir):
    return _csv_roundtrip(spark, sf_dir, ";")


def csv_inferred(spark, sf_dir):
    path = sinks.Staging(spark).path("csv")
    sinks.write_csv(_named_parts(spark, sf_dir), path)
    return sources.read_csv(spark, path)


def partitioned_roundtrip(spark, sf_dir):
    path = sinks.Staging(spark).path("calendar")
    sinks.write_parquet(calendar_dim(spark, sf_dir), path, schemas.CALENDAR_PARTITIONS, small_folders=True)
    return sources.load_table(spark, path).where("arrival_year = 1996")


def partitioned_rebalanced(spark, sf_dir):
    path = sinks.Staging(spark).path("orders")
    dated = table(spark, sf_dir, "orders").withColumn("order_year", F.year("o_orderdate"))
    sinks.write_parquet(dated, path, ["order_year", "o_orderstatus"])
    return sources.load_table(spark, path).where("order_year >= 1998")


def label_catalog(spark, sf_dir):
    """Part names as labels of their size; the last part of a size wins."""
    path = sinks.Staging(spark).path("labels")
    parts = table(spark, sf_dir, "part").repartitionByRange("p_partkey").sortWithinPartitions("p_partkey")
    sinks.write_text(parts.selectExpr("concat('   ', p_size, ' =  ''', p_name, '''') AS line"), path, "line")
    return sources.read_label_catalog(spark, path)


def label_catalog_nations(spark, sf_dir):
    path = sinks.Staging(spark).path("labels")
    lines = table(spark, sf_dir, "nation").selectExpr("concat('   ', n_nationkey, ' =  ''', n_name, '''') AS line")
    sinks.write_text(lines, path, "line")
    return sources.read_label_catalog(spark, path)


def label_catalog_section(spark, sf_dir):
    """Nations and regions as two sections of one file, with codes in common."""
    label = "concat('   ', {}, ' =  ''', {}, '''')"
    lines = [
        "SELECT 0 AS part, CAST(-1 AS BIGINT) AS at, '  value nations' AS line",
        f"SELECT 0, n_nationkey, {label.format('n_nationkey', 'n_name')} FROM {{nations}}",
        "SELECT 0, 1000000, ';'",
        "SELECT 1, -1, '  value $regions'",
        f"SELECT 1, r_regionkey, {label.format('r_regionkey', 'r_name')} FROM {{regions}}",
        "SELECT 1, 1000000, ';'",
    ]
    whole = spark.sql(
        " UNION ALL ".join(lines), nations=table(spark, sf_dir, "nation"), regions=table(spark, sf_dir, "region")
    )
    staging = sinks.Staging(spark)
    path = staging.path("labels")
    sinks.write_text(whole.repartitionByRange(1, "part", "at").sortWithinPartitions("part", "at"), path, "line")
    return sources.read_label_catalog(spark, path, section="regions", staging=staging)


def csv_roundtrip_multiline(spark, sf_dir):
    path = sinks.Staging(spark).path("csv")
    parts = table(spark, sf_dir, "part")
    name = F.concat("p_name", F.lit("\n"), "p_brand", F.lit(', "'), F.col("p_size").cast("string"), F.lit('"\n'))
    named = parts.select(F.col("p_partkey").alias("code"), name.alias("Name"))
    sinks.write_csv(named, path)
    return sources.read_csv(spark, path, named.schema, multiline=True)


def csv_rejects(spark, sf_dir):
    """Sizes of some parts are no numbers; their lines are set aside and counted by column."""
    path = sinks.Staging(spark).path("csv")
    parts = table(spark, sf_dir, "part").selectExpr(
        "p_partkey",
        "p_name",
        "CASE WHEN p_size < 5 THEN concat(p_size, ' or so') ELSE CAST(p_size AS STRING) END AS p_size",
        "CASE WHEN p_size = 4 THEN 'dear' ELSE CAST(p_retailprice AS STRING) END AS price",
    )
    sinks.write_csv(parts, path)
    good, bad = sources.read_csv_with_rejects(spark, path, "p_partkey long, p_name string, p_size int, price double")
    count = F.count(F.lit(1)).alias("n")
    lost = bad.select(F.explode("bad_columns").alias("column_name")).groupBy("column_name").agg(count)
    return lost.unionByName(good.agg(count).select(F.lit("(fits)").alias("column_name"), "n"))


# ---------------------------------------------------------------- projections


def select_columns(spark, sf_dir):
    return ops.select_columns(table(spark, sf_dir, "customer"), ["c_custkey", "c_mktsegment"])


def drop_columns(spark, sf_dir):
    return ops.drop_columns(table(spark, sf_dir, "orders"), ["o_orderpriority", "_c0"])


def drop_sparse_columns(spark, sf_dir):
    return ops.drop_sparse(standins.arrivals(spark, sf_dir), 0.9)


def rename_columns(spark, sf_dir):
    return ops.rename_columns(
        table(spark, sf_dir, "part"),
        {"p_partkey": "part_key", "p_name": "part_name", "p_brand": "brand", "p_retailprice": "retail_price"},
    )


def all_doubles_to_int(spark, sf_dir):
    return ops.doubles_to_int(standins.arrivals(spark, sf_dir), ["admnum"])


# ---------------------------------------------------------------- filters and profiles


def _holey_lines(spark, sf_dir):
    """Line items with nulls and NaN made from the values."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey",
        "l_linenumber",
        "nullif(l_discount, 0.0) AS l_discount",
        "CASE WHEN l_tax = 0.0 THEN CAST('NaN' AS DOUBLE) WHEN l_tax = 0.08 THEN NULL ELSE l_tax END AS l_tax",
        "nullif(l_returnflag, 'N') AS l_returnflag",
        "l_linestatus",
        "CASE WHEN l_quantity > 10 THEN l_shipdate END AS l_shipdate",
    )


def dropna_single(spark, sf_dir):
    return ops.drop_missing(_holey_lines(spark, sf_dir), ["l_discount"])


def dropna_any(spark, sf_dir):
    return ops.drop_missing(_holey_lines(spark, sf_dir), ["l_discount", "l_tax", "l_returnflag"])


def dropna_loss(spark, sf_dir):
    return ops.dropna_loss(_holey_lines(spark, sf_dir), ["l_discount", "l_tax"])


def dedup_loss(spark, sf_dir):
    return ops.dedup_loss(table(spark, sf_dir, "lineitem"), LINE_KEY)


def cleaning_loss(spark, sf_dir):
    return loss_report(
        standins.arrivals(spark, sf_dir),
        standins.demographics(spark, sf_dir),
        standins.temperature(spark, sf_dir),
    )


def null_profile(spark, sf_dir):
    return ops.null_profile(_holey_lines(spark, sf_dir))


def null_percent(spark, sf_dir):
    return ops.null_percent(_holey_lines(spark, sf_dir))


def row_count(spark, sf_dir):
    return ops.row_counts({t: table(spark, sf_dir, t) for t in TABLES})


def distinct_values(spark, sf_dir):
    return ops.distinct_values(table(spark, sf_dir, "customer"), "c_mktsegment")


def avg_by_group(spark, sf_dir):
    return ops.average_by(standins.temperature(spark, sf_dir), "Country", "AverageTemperature", "average_temperature")


def avg_unrounded(spark, sf_dir):
    """Means of values that no double holds exactly, which depend on the order in an ordinary sum."""
    return ops.average_by(table(spark, sf_dir, "customer"), "c_nationkey", "c_acctbal", "average_balance")


def preview(spark, sf_dir):
    return ops.preview(table(spark, sf_dir, "orders"), ["o_orderkey"], 5)


# ---------------------------------------------------------------- dedup


def dedup_single_key(spark, sf_dir):
    return ops.dedup(table(spark, sf_dir, "documents"), ["text"], [F.col("doc_id")])


def dedup_composite_key(spark, sf_dir):
    return ops.dedup(table(spark, sf_dir, "lineitem"), LINE_KEY)


def dedup_rare_keys(spark, sf_dir):
    """About one row in a hundred repeats its key."""
    return ops.dedup_rare(table(spark, sf_dir, "lineitem"), ["l_partkey", "l_shipdate"])


# ---------------------------------------------------------------- scalar functions


def double_to_int(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        fx.truncate_to_int(F.col("c_acctbal")).alias("balance"),
        fx.truncate_to_int(-F.col("c_acctbal")).alias("negated"),
        fx.truncate_to_int(F.col("c_acctbal") * 1e6).alias("overflowing"),
        fx.truncate_to_int(F.col("c_acctbal") * 1e6, wide=True).alias("wide"),
    )


def _day_numbers(spark, sf_dir):
    """Days since 1995-01-01, where the order dates begin: day 0 occurs."""
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "CAST(datediff(o_orderdate, DATE'1995-01-01') AS DOUBLE) AS days"
    )


def sas_date(spark, sf_dir):
    days = F.col("days")
    return _day_numbers(spark, sf_dir).select(
        "o_orderkey",
        fx.sas_date(days).alias("kept"),
        fx.sas_date(days, zero_as_null=True).alias("zero_null"),
        fx.sas_date(-days).alias("before_epoch"),
    )


def sas_date_string(spark, sf_dir):
    days = F.col("days")
    return _day_numbers(spark, sf_dir).select(
        "o_orderkey",
        fx.sas_date_string(days).alias("iso"),
        fx.sas_date_string(days, zero_as_null=False).alias("iso_kept"),
    )


def date_to_string(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.col("o_orderdate").cast("string").alias("stamp"),
        F.col("o_orderdate").cast("date").cast("string").alias("day"),
    )


def title_case(spark, sf_dir):
    name = F.concat_ws("-", F.upper("p_name"), F.lower("p_brand"), F.concat(F.lit("o'"), F.lower("p_type")), F.lit("(u.s.a.)"))
    return table(spark, sf_dir, "part").select("p_partkey", fx.title_case(name).alias("titled"))


def calendar_parts(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("day_of"))
    return orders.withColumns(fx.calendar_parts(F.col("day_of")))


def format_count(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", fx.format_count(F.col("o_orderkey") * F.col("o_custkey")).alias("formatted")
    )


def format_float(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        fx.format_float(F.col("o_totalprice")).alias("price"),
        fx.format_float(-F.col("o_totalprice") / 8).alias("eighth"),
    )


# ---------------------------------------------------------------- keys and dimensions


def _orders_with_gaps(spark, sf_dir):
    return table(spark, sf_dir, "orders").withColumn("o_orderpriority", F.nullif("o_orderpriority", F.lit("5-LOW")))


def _priority_dim(spark, sf_dir):
    """The stored dimension, read back as the fact builder does."""
    staging = sinks.Staging(spark)
    dim = plans.build_key_dimension(_orders_with_gaps(spark, sf_dir), "o_orderpriority", "priority_key", staging)
    return staging.write(dim, "priority")


def dim_surrogate_key(spark, sf_dir):
    return plans.build_key_dimension(_orders_with_gaps(spark, sf_dir), "o_orderpriority", "priority_key")


def dim_key_merge(spark, sf_dir):
    """Keys of the customers in the first half of the orders, then of those in all of them: the former stay."""
    staging = sinks.Staging(spark)
    orders = table(spark, sf_dir, "orders")
    half = orders.agg(F.max("o_orderkey")).first()[0] // 2
    first = plans.build_key_dimension(orders.where(F.col("o_orderkey") <= half), "o_custkey", "customer_key", staging)
    return plans.build_key_dimension(orders, "o_custkey", "customer_key", staging, staging.write(first, "customers"))


def dense_key_large(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    first = ["l_orderkey", "l_partkey", "l_suppkey"]
    order = first + [c for c in lines.columns if c not in first]
    numbered = ops.dense_key_by_range(lines, order, "id")
    return numbered.select("id", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")


def calendar_dim(spark, sf_dir):
    dates = table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("arrdate"))
    return plans.build_calendar_dimension(dates)


def _country_sources(spark, sf_dir):
    codes = standins.arrivals(spark, sf_dir).select(fx.truncate_to_int(F.col("i94res")).alias("i94res"))
    return codes, standins.mapping(spark, sf_dir), standins.temperature(spark, sf_dir)


def country_dim(spark, sf_dir):
    """Exact names: the readings are respelled in upper case, as the mapping has them."""
    codes, mapping, readings = _country_sources(spark, sf_dir)
    readings = readings.withColumn("Country", F.upper("Country"))
    return plans.build_country_dimension(codes, mapping, readings, titled=False)


def country_dim_titled(spark, sf_dir):
    return plans.build_country_dimension(*_country_sources(spark, sf_dir))


def demographics_dim(spark, sf_dir):
    staging = sinks.Staging(spark)
    cities = staging.write(plans.clean_demographics(standins.demographics(spark, sf_dir)), "demographics")
    return plans.build_demographics_dimension(cities, staging=staging)


# ---------------------------------------------------------------- joins and fact


def _fact(spark, sf_dir, null_safe=False, limit=None):
    orders = _orders_with_gaps(spark, sf_dir)
    dim = _priority_dim(spark, sf_dir)
    on = {"o_orderpriority": "o_orderpriority"}
    return ops.lookup_join(orders, dim, on, null_safe, limit).drop("o_orderpriority")


def fact_dim_key(spark, sf_dir):
    return _fact(spark, sf_dir)


def fact_dim_key_nullsafe(spark, sf_dir):
    return _fact(spark, sf_dir, null_safe=True)


def fact_dim_key_shuffled(spark, sf_dir):
    """The way taken when the dimension is too large to broadcast."""
    return _fact(spark, sf_dir, limit=0)


# ---------------------------------------------------------------- recipes and the whole job


def clean_arrivals(spark, sf_dir):
    return plans.clean_arrivals(standins.arrivals(spark, sf_dir))


def clean_arrivals_text_dates(spark, sf_dir):
    cleaned = plans.clean_arrivals(standins.arrivals(spark, sf_dir), zero_as_null=True, as_string=True)
    return cleaned.select("cicid", "arrdate", "depdate", "admnum", "visatype")


def clean_temperature(spark, sf_dir):
    return plans.clean_temperature(standins.temperature(spark, sf_dir))


def clean_demographics(spark, sf_dir):
    return plans.clean_demographics(standins.demographics(spark, sf_dir))


def quality_row_count(spark, sf_dir):
    frames = {t: table(spark, sf_dir, t) for t in ("orders", "lineitem", "customer")}
    frames["none"] = frames["orders"].where("o_orderkey < 0")
    return ops.check_not_empty(frames)


def quality_duplicate_key(spark, sf_dir):
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    return ops.check_unique({"lineitem": (lines, LINE_KEY), "orders": (orders, ["o_orderkey"])})


def quality_null_key(spark, sf_dir):
    return ops.check_not_null(
        {
            "lineitem": (_holey_lines(spark, sf_dir), ["l_orderkey", "l_returnflag"]),
            "orders": (_orders_with_gaps(spark, sf_dir), ["o_orderkey", "o_orderpriority"]),
        }
    )


def _star_sources(spark, sf_dir):
    return tuple(read(spark, sf_dir) for read in (standins.arrivals, standins.demographics, standins.temperature, standins.mapping))


def _star(spark, sf_dir):
    return plans.build_star(*_star_sources(spark, sf_dir), sinks.Staging(spark).path("star"))


def star_checks(spark, sf_dir):
    """The whole job, published; the checks that were stored with the version that readers find."""
    out = sinks.Staging(spark).path("star")
    plans.publish_star(*_star_sources(spark, sf_dir), out, strict=False)
    return plans.open_star(spark, out).checks


def star_losses(spark, sf_dir):
    """The whole job, then what its cleaning lost."""
    return _star(spark, sf_dir).losses


def star_rejects(spark, sf_dir):
    """The whole job from CSV files in which some lines of two sources do not fit; its losses, those lines among them."""
    staging = sinks.Staging(spark)
    demographics = standins.demographics(spark, sf_dir).withColumn(
        "Median Age", F.when(F.col("Count") == 7, "young").otherwise(F.col("Median Age").cast("string"))
    )
    temperature = standins.temperature(spark, sf_dir).withColumn(
        "AverageTemperature", F.when(F.col("Latitude") == "5N", "mild").otherwise(F.col("AverageTemperature").cast("string"))
    )
    paths = {name: staging.path(name) for name in ("arrivals", "demographics", "temperature", "mapping", "star")}
    sinks.write_parquet(standins.arrivals(spark, sf_dir), paths["arrivals"])
    sinks.write_csv(demographics, paths["demographics"], ";")
    sinks.write_csv(temperature, paths["temperature"])
    sinks.write_csv(standins.mapping(spark, sf_dir), paths["mapping"])
    return plans.run_etl(spark, *paths.values(), rejects=True, strict=False).losses


def _grown_star(spark, sf_dir):
    """The arrivals of voyages up to 1995 published, then those from 1996 on added.

    Records repeat across the two, so months of the first part are touched, too.
    """
    out = sinks.Staging(spark).path("star")
    arrivals, *others = _star_sources(spark, sf_dir)
    plans.publish_star(arrivals.where("i94yr < 1996"), *others, out, strict=False)
    plans.publish_increment(arrivals.where("i94yr >= 1996"), *others, out, strict=False)
    return plans.open_star(spark, out)


def star_increment(spark, sf_dir):
    """The fact after an increment, with visa types, as keys depend on the order in which types came."""
    star = _grown_star(spark, sf_dir)
    return ops.lookup_join(star.immigration_fact, star.visatype, {"visa_type_key": "visa_type_key"}).drop("visa_type_key")


def star_increment_losses(spark, sf_dir):
    """What cleaning lost in both runs together."""
    return _grown_star(spark, sf_dir).losses


def star_integrity(spark, sf_dir):
    """References of line items to parts and orders of which some are taken away."""
    lines = table(spark, sf_dir, "lineitem")
    parts = table(spark, sf_dir, "part").where("p_size > 3")
    orders = table(spark, sf_dir, "orders")
    return ops.check_references(
        {
            ("lineitem", "l_partkey"): (lines, parts, "p_partkey"),
            ("lineitem", "l_orderkey"): (lines, orders, "o_orderkey"),
        }
    )


def star_summary_shuffled(spark, sf_dir):
    """The summary with every dimension joined by shuffle."""
    star = _star(spark, sf_dir)
    summary = plans.star_summary(star.immigration_fact, star.country, star.immigration_time, star.visatype, limit=0)
    return summary.withColumn("average_temperature", F.round("average_temperature", 8))


def star_fact(spark, sf_dir):
    """The whole job, then its fact table."""
    return _star(spark, sf_dir).immigration_fact


def star_year(spark, sf_dir):
    """The whole job, then the summary of a single year, which reads that year's files."""
    star = _star(spark, sf_dir)
    tables = star.immigration_fact, star.country, star.immigration_time, star.visatype
    return plans.star_summary(*tables, years=(1995, 1995)).withColumn("average_temperature", F.round("average_temperature", 8))


def star_summary(spark, sf_dir):
    """The whole job, then the fact table over its dimensions."""
    star = _star(spark, sf_dir)
    summary = plans.star_summary(star.immigration_fact, star.country, star.immigration_time, star.visatype)
    return summary.withColumn("average_temperature", F.round("average_temperature", 8))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in [
        scan_parquet, parquet_roundtrip, csv_roundtrip, csv_semicolon_roundtrip, csv_inferred,
        partitioned_roundtrip, partitioned_rebalanced, label_catalog, label_catalog_nations, label_catalog_section,
        csv_roundtrip_multiline, csv_rejects,
        select_columns, drop_columns, drop_sparse_columns, rename_columns, all_doubles_to_int,
        dropna_single, dropna_any, dropna_loss, dedup_loss, cleaning_loss, null_profile, null_percent,
        row_count, distinct_values, avg_by_group, avg_unrounded, preview,
        dedup_single_key, dedup_composite_key, dedup_rare_keys,
        double_to_int, sas_date, sas_date_string, date_to_string, title_case, calendar_parts, format_count, format_float,
        dim_surrogate_key, dense_key_large, calendar_dim, country_dim, country_dim_titled, demographics_dim,
        fact_dim_key, fact_dim_key_nullsafe, fact_dim_key_shuffled,
        clean_arrivals, clean_arrivals_text_dates, clean_temperature, clean_demographics,
        quality_row_count, quality_duplicate_key, quality_null_key,
        dim_key_merge, star_rejects,
        star_increment, star_increment_losses,
        star_checks, star_fact, star_summary, star_losses, star_integrity, star_summary_shuffled, star_year,
    ]
}
