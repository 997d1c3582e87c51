"""Source tables in the shape the library expects, derived from the test tables.

Each one is a projection of a whole test table; the SQL texts of
:mod:`workload.oracle` state the same projections.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """28 columns per line item.

    Records repeat, some record numbers are fractional, NaN or too large, some
    dates lie beyond the calendar, ``occup``, ``entdepu`` and ``insnum`` are nearly empty, some
    departure dates and visa types are null, ``admnum`` exceeds 32 bits and
    residence codes from 25 on have no name.
    """
    return table(spark, sf_dir, "lineitem").selectExpr(
        "CASE l_partkey % 97 WHEN 5 THEN l_orderkey * 8 + l_linenumber + 0.25D WHEN 6 THEN CAST('NaN' AS DOUBLE) "
        "WHEN 7 THEN 1e300D * l_linenumber ELSE CAST(l_orderkey * 8 + l_linenumber AS DOUBLE) END AS cicid",
        "CAST(year(l_shipdate) AS DOUBLE) AS i94yr",
        "CAST(month(l_shipdate) AS DOUBLE) AS i94mon",
        "CAST(l_linenumber AS DOUBLE) AS i94cit",
        "l_quantity AS i94res",
        "concat('P', l_suppkey) AS i94port",
        "CASE l_partkey % 97 WHEN 8 THEN 99999999D WHEN 9 THEN -2147483648D "
        "ELSE CAST(datediff(l_shipdate, DATE'1960-01-01') AS DOUBLE) END AS arrdate",
        "CAST(l_linenumber AS DOUBLE) AS i94mode",
        "l_linestatus AS i94addr",
        "nullif(CAST(datediff(l_shipdate, DATE'1960-01-01') AS DOUBLE) + l_linenumber, 13000.0) AS depdate",
        "l_quantity + 0.5 AS i94bir",
        "-l_discount * 100.25 AS i94visa",
        "CAST(1 AS DOUBLE) AS count",
        "CAST(CAST(l_shipdate AS DATE) AS STRING) AS dtadfile",
        "concat('V', l_linenumber) AS visapost",
        "CASE WHEN l_quantity = 50.0 THEN l_returnflag END AS occup",
        "l_returnflag AS entdepa",
        "l_linestatus AS entdepd",
        "CASE WHEN l_quantity = 49.0 THEN l_returnflag END AS entdepu",
        "nullif(l_returnflag, 'R') AS matflag",
        "1950.0 + l_quantity AS biryear",
        "concat('D', l_linenumber) AS dtaddto",
        "nullif(l_linestatus, 'F') AS gender",
        "CASE WHEN l_quantity = 48.0 THEN l_returnflag END AS insnum",
        "concat('A', l_linenumber) AS airline",
        "l_extendedprice * 1000000.0 AS admnum",
        "CAST(l_partkey AS STRING) AS fltno",
        "nullif(concat(l_returnflag, l_linestatus), 'NO') AS visatype",
    )


def mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").selectExpr("n_nationkey AS code", "n_name AS Name")


def temperature(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One reading per customer; negative balances give nulls, days and cities repeat.

    Readings are quarter degrees, whose sums are exact in any order.
    """
    return table(spark, sf_dir, "customer").selectExpr(
        "date_add(DATE'1743-11-01', CAST(floor(abs(c_acctbal) / 500) AS INT)) AS dt",
        "CASE WHEN c_acctbal >= 0 THEN floor(c_acctbal / 100) / 4 END AS AverageTemperature",
        "c_acctbal / 1000 AS AverageTemperatureUncertainty",
        "c_mktsegment AS City",
        "concat('Nation_', c_nationkey) AS Country",
        "concat(c_nationkey, 'N') AS Latitude",
        "concat(c_custkey, 'E') AS Longitude",
    )


def demographics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per part; several figures are null and city keys repeat."""
    return table(spark, sf_dir, "part").selectExpr(
        "p_name AS City",
        "p_type AS State",
        "p_retailprice / 30 AS `Median Age`",
        "nullif(p_size, 3) AS `Male Population`",
        "nullif(p_size + 1, 9) AS `Female Population`",
        "2 * p_size + 1 AS `Total Population`",
        "nullif(p_size + 2, 22) AS `Number of Veterans`",
        "nullif(p_size + 3, 22) AS `Foreign-born`",
        "CASE WHEN p_size = 40 THEN CAST('NaN' AS DOUBLE) ELSE p_size / 10 END AS `Average Household Size`",
        "upper(substring(p_type, 1, 2)) AS `State Code`",
        "p_brand AS Race",
        "p_size AS Count",
    )
