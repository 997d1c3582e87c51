"""Compare a Spark result with the SQL result: names, types and all values."""

import duckdb
import pyarrow as pa

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def normal_type(t):
    if pa.types.is_large_string(t):
        return pa.string()
    if pa.types.is_timestamp(t):
        return pa.timestamp("us")
    return t


def rows(arrow):
    arrow = arrow.select(sorted(arrow.column_names))
    columns = [c.to_pylist() for c in arrow.columns]
    return sorted((tuple(map(repr, r)) for r in zip(*columns)))


def differences(spark_df, sql, con):
    """An empty list when both agree."""
    left, right = spark_df.toArrow(), con.sql(sql).to_arrow_table()
    found = []
    types = [{f.name: normal_type(f.type) for f in t.schema} for t in (left, right)]
    if types[0] != types[1]:
        found.append(f"types differ: {sorted(types[0].items() ^ types[1].items(), key=str)}")
    a, b = rows(left), rows(right)
    if len(a) != len(b):
        found.append(f"{len(a)} rows against {len(b)}")
    if a != b:
        only_a, only_b = set(a) - set(b), set(b) - set(a)
        found.append(f"only in Spark: {sorted(only_a)[:3]}; only in SQL: {sorted(only_b)[:3]}")
    return found
