"""SQL for every query, over the test tables; nulls sort as stated in the text."""

from __future__ import annotations

# Fixed value: the place of every column in the derived arrivals table.
ARRIVALS_COLUMNS = [
    "cicid", "i94yr", "i94mon", "i94cit", "i94res", "i94port", "arrdate", "i94mode", "i94addr",
    "depdate", "i94bir", "i94visa", "count", "dtadfile", "visapost", "occup", "entdepa", "entdepd",
    "entdepu", "matflag", "biryear", "dtaddto", "gender", "insnum", "airline", "admnum", "fltno",
    "visatype",
]
SPARSE = ["occup", "entdepu", "insnum"]
DOUBLES = [
    "cicid", "i94yr", "i94mon", "i94cit", "i94res", "arrdate", "i94mode", "depdate", "i94bir",
    "i94visa", "count", "biryear", "admnum",
]


def _q(names: list[str]) -> str:
    return ", ".join(f'"{n}"' for n in names)


def _first(names: list[str]) -> str:
    return ", ".join(f'"{n}" ASC NULLS FIRST' for n in names)


def _last(names: list[str]) -> str:
    return ", ".join(f'"{n}" ASC NULLS LAST' for n in names)


ARRIVALS = """arrivals AS (
  SELECT CASE l_partkey % 97 WHEN 5 THEN CAST(l_orderkey * 8 + l_linenumber + 0.25 AS DOUBLE)
      WHEN 6 THEN CAST('NaN' AS DOUBLE) WHEN 7 THEN CAST('1e300' AS DOUBLE) * l_linenumber
      ELSE CAST(l_orderkey * 8 + l_linenumber AS DOUBLE) END AS cicid,
    CAST(year(l_shipdate) AS DOUBLE) AS i94yr,
    CAST(month(l_shipdate) AS DOUBLE) AS i94mon,
    CAST(l_linenumber AS DOUBLE) AS i94cit,
    l_quantity AS i94res,
    'P' || l_suppkey AS i94port,
    CASE l_partkey % 97 WHEN 8 THEN CAST(99999999 AS DOUBLE) WHEN 9 THEN CAST(-2147483648 AS DOUBLE)
      ELSE CAST(date_diff('day', DATE '1960-01-01', CAST(l_shipdate AS DATE)) AS DOUBLE) END AS arrdate,
    CAST(l_linenumber AS DOUBLE) AS i94mode,
    l_linestatus AS i94addr,
    nullif(CAST(date_diff('day', DATE '1960-01-01', CAST(l_shipdate AS DATE)) AS DOUBLE) + l_linenumber, 13000.0) AS depdate,
    l_quantity + 0.5 AS i94bir,
    -l_discount * 100.25 AS i94visa,
    CAST(1 AS DOUBLE) AS "count",
    CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS dtadfile,
    'V' || l_linenumber AS visapost,
    CASE WHEN l_quantity = 50.0 THEN l_returnflag END AS occup,
    l_returnflag AS entdepa,
    l_linestatus AS entdepd,
    CASE WHEN l_quantity = 49.0 THEN l_returnflag END AS entdepu,
    nullif(l_returnflag, 'R') AS matflag,
    1950.0 + l_quantity AS biryear,
    'D' || l_linenumber AS dtaddto,
    nullif(l_linestatus, 'F') AS gender,
    CASE WHEN l_quantity = 48.0 THEN l_returnflag END AS insnum,
    'A' || l_linenumber AS airline,
    l_extendedprice * 1000000.0 AS admnum,
    CAST(l_partkey AS VARCHAR) AS fltno,
    nullif(l_returnflag || l_linestatus, 'NO') AS visatype
  FROM lineitem)"""

TEMPERATURE = """temperature AS (
  SELECT DATE '1743-11-01' + CAST(floor(abs(c_acctbal) / 500) AS INT) AS dt,
    CASE WHEN c_acctbal >= 0 THEN floor(c_acctbal / 100) / 4 END AS "AverageTemperature",
    c_acctbal / 1000 AS "AverageTemperatureUncertainty",
    c_mktsegment AS "City",
    'Nation_' || c_nationkey AS "Country",
    c_nationkey || 'N' AS "Latitude",
    c_custkey || 'E' AS "Longitude"
  FROM customer)"""

DEMOGRAPHICS = """demographics AS (
  SELECT p_name AS "City", p_type AS "State", p_retailprice / 30 AS "Median Age",
    nullif(p_size, 3) AS "Male Population", nullif(p_size + 1, 9) AS "Female Population",
    2 * p_size + 1 AS "Total Population", nullif(p_size + 2, 22) AS "Number of Veterans",
    nullif(p_size + 3, 22) AS "Foreign-born",
    CASE WHEN p_size = 40 THEN CAST('NaN' AS DOUBLE) ELSE p_size / 10 END AS "Average Household Size",
    upper(substring(p_type, 1, 2)) AS "State Code", p_brand AS "Race", p_size AS "Count"
  FROM part)"""

HOLEY = """holey AS (
  SELECT l_orderkey, l_linenumber, nullif(l_discount, 0.0) AS l_discount,
    CASE WHEN l_tax = 0.0 THEN CAST('NaN' AS DOUBLE) WHEN l_tax = 0.08 THEN NULL ELSE l_tax END AS l_tax,
    nullif(l_returnflag, 'N') AS l_returnflag, l_linestatus,
    CASE WHEN l_quantity > 10 THEN l_shipdate END AS l_shipdate
  FROM lineitem)"""

NOT_NAN = "{0} IS NOT NULL AND NOT isnan({0})"

_dates = {"arrdate", "depdate"}
_kept = [c for c in ARRIVALS_COLUMNS if c not in SPARSE]


def _retyped(name: str, wide: set[str]) -> str:
    if name in _dates:
        day = f"TRY_CAST(trunc({name}) AS INT)"
        return f"CASE WHEN {day} BETWEEN -715509 AND 2936549 THEN DATE '1960-01-01' + {day} END AS {name}"
    if name in DOUBLES:
        return f'TRY_CAST(trunc("{name}") AS {"BIGINT" if name in wide else "INT"}) AS "{name}"'
    return f'"{name}"'


RETYPED = f"""retyped AS (
  SELECT {", ".join(_retyped(c, {"cicid", "admnum"}) for c in _kept)} FROM arrivals)"""

CLEANED = f"""{ARRIVALS}, {RETYPED}, cleaned AS (
  SELECT {_q(_kept)} FROM (
    SELECT {_q(_kept)}, row_number() OVER (PARTITION BY cicid ORDER BY {_first(_kept[1:])}) AS rn
    FROM retyped) WHERE rn = 1)"""

READINGS = f"""{TEMPERATURE}, readings AS (
  SELECT CAST(dt AS VARCHAR) AS dt, "AverageTemperature", "AverageTemperatureUncertainty", "City",
    "Country", "Latitude", "Longitude"
  FROM (
    SELECT *, row_number() OVER (PARTITION BY dt, "City", "Country"
      ORDER BY {_first(["AverageTemperature", "AverageTemperatureUncertainty", "Latitude", "Longitude"])}) AS rn
    FROM temperature WHERE {NOT_NAN.format('"AverageTemperature"')}) WHERE rn = 1)"""

_figures = [
    "Median Age", "Male Population", "Female Population", "Total Population", "Number of Veterans",
    "Foreign-born", "Average Household Size", "Count",
]
CITIES = f"""{DEMOGRAPHICS}, cities AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY "City", "State", "State Code", "Race"
      ORDER BY {_first(_figures)}) AS rn
    FROM demographics
    WHERE "Male Population" IS NOT NULL AND "Female Population" IS NOT NULL
      AND "Number of Veterans" IS NOT NULL AND "Foreign-born" IS NOT NULL
      AND {NOT_NAN.format('"Average Household Size"')}) WHERE rn = 1)"""

GAPS = """gaps AS (SELECT * REPLACE (nullif(o_orderpriority, '5-LOW') AS o_orderpriority) FROM orders)"""

PRIORITY = f"""{GAPS}, priority AS (
  SELECT o_orderpriority, row_number() OVER (ORDER BY o_orderpriority ASC NULLS LAST) - 1 AS priority_key
  FROM (SELECT DISTINCT o_orderpriority FROM gaps))"""


def _fact(comparison: str) -> str:
    return f"""WITH {PRIORITY}
SELECT g.* EXCLUDE (o_orderpriority), p.priority_key
FROM gaps g LEFT JOIN priority p ON g.o_orderpriority {comparison} p.o_orderpriority"""


def _calendar(source: str) -> str:
    return f"""SELECT arrdate, CAST(day(arrdate) AS INT) AS arrival_day,
  CAST(weekofyear(arrdate) AS INT) AS arrival_week, CAST(month(arrdate) AS INT) AS arrival_month,
  CAST(year(arrdate) AS INT) AS arrival_year, CAST(dayofweek(arrdate) + 1 AS INT) AS arrival_weekday,
  row_number() OVER (ORDER BY arrdate ASC NULLS LAST) - 1 AS id
FROM ({source})"""


_order_dates = "SELECT DISTINCT CAST(o_orderdate AS DATE) AS arrdate FROM orders"

_title = """list_aggregate(list_transform(regexp_extract_all(lower({0}), '(\\p{{L}}+|[^\\p{{L}}]+)'),
  lambda x: upper(x[1]) || x[2:]), 'string_agg', '')"""


def _country(codes: str, readings: str, name: str, country: str) -> str:
    return f"""SELECT c.country_code, {name} AS country_name, a.average_temperature
FROM (SELECT DISTINCT i94res AS country_code FROM {codes}) c
LEFT JOIN nation n ON n.n_nationkey = c.country_code
LEFT JOIN (SELECT {country} AS country, avg("AverageTemperature") AS average_temperature
           FROM {readings} GROUP BY ALL) a ON a.country = {name}"""


_raw_codes = "(SELECT CAST(i94res AS INT) AS i94res FROM arrivals)"
_titled_nation = _title.format("n.n_name")

_named_parts = """SELECT p_partkey AS code, p_name || ', ' || p_brand || '; size "' || p_size || '"' AS "Name",
  CASE WHEN p_type = 'SMALL' THEN NULL WHEN p_size % 10 = 0 THEN '' ELSE p_type END AS kind FROM part"""

_fact_names = {"cicid": "record_id", "i94res": "country_residence_code", "i94addr": "state_code"}

STAR = f"""WITH {CLEANED}, {READINGS}, {CITIES},
visatypes AS (
  SELECT visatype, row_number() OVER (ORDER BY visatype ASC NULLS LAST) - 1 AS visa_type_key
  FROM (SELECT DISTINCT visatype FROM cleaned)),
calendar AS ({_calendar("SELECT DISTINCT arrdate FROM cleaned")}),
country AS ({_country("cleaned", "readings", _titled_nation, '"Country"')}),
fact AS (
  SELECT {", ".join(f'c."{c}" AS "{_fact_names.get(c, c)}"' for c in _kept if c != "visatype")}, v.visa_type_key
  FROM cleaned c LEFT JOIN visatypes v ON v.visatype = c.visatype)"""

_unique = [
    ("immigration_time", "id", "calendar"),
    ("immigration_time", "arrdate", "calendar"),
    ("visatype", "visatype", "visatypes"),
    ("immigration_fact", "record_id", "fact"),
    ("visatype", "visa_type_key", "visatypes"),
    ("country", "country_code", "country"),
]
_filled = [
    ("immigration_fact", "record_id", "fact", "record_id"),
    ("visatype", "visa_type_key", "visatypes", "visa_type_key"),
    ("immigration_time", "arrdate", "calendar", "arrdate"),
    ("demographics", "City", "cities", '"City"'),
    ("demographics", "state_code", "cities", '"State Code"'),
    ("country", "country_code", "country", "country_code"),
]
_sizes = [
    ("visatype", "visatypes"),
    ("immigration_time", "calendar"),
    ("country", "country"),
    ("demographics", "cities"),
    ("immigration_fact", "fact"),
]
STAR_CHECKS = (
    STAR
    + " "
    + " UNION ALL ".join(
        [
            f"SELECT 'not_empty' AS check_name, '{t}' AS table_name, '' AS columns, count(*) AS measured, "
            f"CASE WHEN count(*) > 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM {rel}"
            for t, rel in _sizes
        ]
        + [
            f"SELECT 'unique', '{t}', '{k}', count(*), CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'FAIL' END "
            f"FROM (SELECT {k} FROM {rel} GROUP BY {k} HAVING count(*) > 1)"
            for t, k, rel in _unique
        ]
        # ids of the demographics are row numbers, here as there
        + [
            "SELECT 'unique', 'demographics', 'id', count(*), CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'FAIL' END "
            "FROM (SELECT id FROM (SELECT row_number() OVER (ORDER BY "
            f"{_last(['City', 'State', 'State Code', 'Race'])}) - 1 AS id FROM cities) GROUP BY id HAVING count(*) > 1)"
        ]
        + [
            f"SELECT 'not_null', '{t}', '{k}', count(*) FILTER ({expr} IS NULL), "
            f"CASE WHEN count(*) FILTER ({expr} IS NULL) = 0 THEN 'PASS' ELSE 'FAIL' END FROM {rel}"
            for t, k, rel, expr in _filled
        ]
        + [
            "SELECT 'unique', 'demographics', 'City,State,state_code,Race', count(*), "
            "CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'FAIL' END "
            'FROM (SELECT 1 FROM cities GROUP BY "City", "State", "State Code", "Race" HAVING count(*) > 1)'
        ]
        + [
            f"SELECT 'references', 'immigration_fact', '{k}', count(*), "
            f"CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'FAIL' END FROM fact "
            f"WHERE {k} IS NOT NULL AND {k} NOT IN (SELECT {c} FROM {rel} WHERE {c} IS NOT NULL)"
            for k, rel, c in [
                ("country_residence_code", "country", "country_code"),
                ("arrdate", "calendar", "arrdate"),
                ("visa_type_key", "visatypes", "visa_type_key"),
            ]
        ]
        + [
            f"SELECT 'complete', '{t}', '', abs(n), CASE WHEN n = 0 THEN 'PASS' ELSE 'FAIL' END FROM "
            f"(SELECT (SELECT count(*) FROM {rel}) - (SELECT count(*) FROM ({wanted})) AS n)"
            for t, rel, wanted in [
                ("immigration_fact", "fact", "SELECT DISTINCT cicid FROM retyped"),
                ("demographics", "cities", 'SELECT DISTINCT "City", "State", "State Code", "Race" FROM cities'),
                ("country", "country", "SELECT DISTINCT country_residence_code FROM fact"),
                ("immigration_time", "calendar", "SELECT DISTINCT arrdate FROM fact"),
            ]
        ]
    )
)


def _loss(source: str, relation: str, missing: str, keys: str) -> str:
    return f"""SELECT '{source}' AS source, CAST(sum(n) AS BIGINT) AS before,
  CAST(sum(m) AS BIGINT) AS dropped_missing,
  CAST(sum(n) - sum(m) - count(*) FILTER (n > m) AS BIGINT) AS dropped_duplicates,
  count(*) FILTER (n > m) AS after
FROM (SELECT count(*) AS n, count(*) FILTER ({missing}) AS m FROM {relation} GROUP BY {keys})"""


_lost = [
    """CAST("{0}" IS NOT NULL AND NOT isnan("{0}") AND {1} IS NULL AS BIGINT)""".format(
        c, _retyped(c, {"cicid", "admnum"}).rsplit(" AS ", 1)[0]
    )
    for c in DOUBLES
]
LOSSES = (
    f"WITH {ARRIVALS}, {RETYPED}, {DEMOGRAPHICS}, {TEMPERATURE}, losses AS ("
    + _loss("arrivals", "retyped", "false", "cicid")
    + " UNION ALL "
    + _loss(
        "demographics",
        "demographics",
        '"Male Population" IS NULL OR "Female Population" IS NULL OR "Number of Veterans" IS NULL '
        'OR "Foreign-born" IS NULL OR "Average Household Size" IS NULL OR isnan("Average Household Size")',
        '"City", "State", "State Code", "Race"',
    )
    + " UNION ALL "
    + _loss("temperature", "temperature", '"AverageTemperature" IS NULL', 'dt, "City", "Country"')
    + f""") SELECT l.*,
  CASE source WHEN 'arrivals' THEN (SELECT CAST(sum({_lost[0]}) AS BIGINT) FROM arrivals) ELSE 0 END AS nulled_keys,
  CASE source WHEN 'arrivals' THEN (SELECT CAST(sum({" + ".join(_lost)}) AS BIGINT) FROM arrivals) ELSE 0 END AS nulled_values
FROM losses l"""
)


_row_tables = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
]

_holey_columns = ["l_orderkey", "l_linenumber", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


def _missing(name: str) -> str:
    return f"({name} IS NULL OR isnan({name}))" if name in ("l_discount", "l_tax") else f"{name} IS NULL"


_line_columns = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
]


def _lines_by(keys: list[str]) -> str:
    rest = [c for c in _line_columns if c not in keys]
    return f"""SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY {_q(keys)} ORDER BY {_first(rest)}) AS rn FROM lineitem) WHERE rn = 1"""


def _status(passed: str) -> str:
    return f"CASE WHEN {passed} THEN 'PASS' ELSE 'FAIL' END AS status"


def _unique_check(name: str, keys: str) -> str:
    return f"""SELECT '{name}' AS table_name, '{keys}' AS key_columns,
  count(*) FILTER (n > 1) AS duplicate_groups, CAST(sum(n - 1) AS BIGINT) AS excess_rows,
  {_status("count(*) FILTER (n > 1) = 0")}
FROM (SELECT count(*) AS n FROM {name} GROUP BY {keys})"""


def _null_check(name: str, relation: str, column: str) -> str:
    nulls = f"count(*) FILTER ({column} IS NULL)"
    return (
        f"SELECT '{name}' AS table_name, '{column}' AS column_name, {nulls} AS null_values, "
        f"{_status(nulls + ' = 0')} FROM {relation}"
    )


SUMMARY = f"""{STAR}
SELECT c.country_name, d.arrival_year, v.visa_type_key, v.visatype, count(*) AS arrivals,
  round(avg(c.average_temperature), 8) AS average_temperature
FROM fact f LEFT JOIN country c ON c.country_code = f.country_residence_code
LEFT JOIN calendar d ON d.arrdate = f.arrdate
LEFT JOIN visatypes v ON v.visa_type_key = f.visa_type_key
GROUP BY ALL"""

ORACLE: dict[str, str] = {
    "scan_parquet": "SELECT * FROM nation",
    "parquet_roundtrip": "SELECT * FROM orders",
    "csv_roundtrip": _named_parts,
    "csv_semicolon_roundtrip": _named_parts,
    "csv_inferred": f"SELECT CAST(code AS INT) AS code, \"Name\", kind FROM ({_named_parts})",
    "partitioned_roundtrip": f"SELECT * FROM ({_calendar(_order_dates)}) WHERE arrival_year = 1996",
    "partitioned_rebalanced": """SELECT *, CAST(year(o_orderdate) AS INT) AS order_year FROM orders
WHERE year(o_orderdate) >= 1998""",
    "label_catalog": """SELECT CAST(p_size AS VARCHAR) AS code, arg_max(p_name, p_partkey) AS name
FROM part GROUP BY p_size""",
    "label_catalog_nations": "SELECT CAST(n_nationkey AS VARCHAR) AS code, n_name AS name FROM nation",
    "label_catalog_section": "SELECT CAST(r_regionkey AS VARCHAR) AS code, r_name AS name FROM region",
    "csv_roundtrip_multiline": """SELECT p_partkey AS code,
  p_name || chr(10) || p_brand || ', "' || p_size || '"' || chr(10) AS "Name" FROM part""",
    "csv_rejects": """SELECT 'p_size' AS column_name, count(*) AS n FROM part WHERE p_size < 5
UNION ALL SELECT 'price', count(*) FROM part WHERE p_size = 4
UNION ALL SELECT '(fits)', count(*) FROM part WHERE p_size >= 5""",
    "select_columns": "SELECT c_custkey, c_mktsegment FROM customer",
    "drop_columns": "SELECT * EXCLUDE (o_orderpriority) FROM orders",
    "drop_sparse_columns": f"WITH {ARRIVALS} SELECT {_q(_kept)} FROM arrivals",
    "rename_columns": """SELECT p_partkey AS part_key, p_name AS part_name, p_brand AS brand, p_type, p_size,
  p_retailprice AS retail_price FROM part""",
    "all_doubles_to_int": f"WITH {ARRIVALS} SELECT "
    + ", ".join(
        f'TRY_CAST(trunc("{c}") AS {"BIGINT" if c == "admnum" else "INT"}) AS "{c}"' if c in DOUBLES else f'"{c}"'
        for c in ARRIVALS_COLUMNS
    )
    + " FROM arrivals",
    "dropna_single": f"WITH {HOLEY} SELECT * FROM holey WHERE NOT {_missing('l_discount')}",
    "dropna_any": f"""WITH {HOLEY} SELECT * FROM holey
WHERE NOT {_missing('l_discount')} AND NOT {_missing('l_tax')} AND l_returnflag IS NOT NULL""",
    "dropna_loss": f"""WITH {HOLEY} SELECT count(*) AS before, count(*) - count(*) FILTER (lost) AS after,
  count(*) FILTER (lost) AS dropped
FROM (SELECT {_missing('l_discount')} OR {_missing('l_tax')} AS lost FROM holey)""",
    "dedup_loss": """SELECT (SELECT count(*) FROM lineitem) AS before, count(*) AS after,
  (SELECT count(*) FROM lineitem) - count(*) AS dropped
FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)""",
    "cleaning_loss": LOSSES,
    "star_losses": LOSSES,
    "star_rejects": f"""SELECT l.*, CASE source WHEN 'demographics' THEN (SELECT count(*) FROM part WHERE p_size = 7)
  WHEN 'temperature' THEN (SELECT count(*) FROM customer WHERE c_nationkey = 5) ELSE 0 END AS rejected
FROM ({LOSSES.replace("FROM part)", "FROM part WHERE p_size <> 7)").replace("FROM customer)", "FROM customer WHERE c_nationkey <> 5)")}) l""",
    "null_profile": f"WITH {HOLEY} SELECT "
    + ", ".join(f"count(*) FILTER ({_missing(c)}) AS {c}" for c in _holey_columns)
    + " FROM holey",
    "null_percent": f"WITH {HOLEY} SELECT * FROM ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER ({_missing(c)}) AS null_values, "
        f"CAST(100.0 AS DOUBLE) * count(*) FILTER ({_missing(c)}) / count(*) AS pct_missing FROM holey"
        for c in _holey_columns
    )
    + ") WHERE pct_missing > 0",
    "row_count": " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in _row_tables),
    "distinct_values": "SELECT DISTINCT c_mktsegment FROM customer",
    "avg_by_group": f"""WITH {TEMPERATURE}
SELECT "Country", avg("AverageTemperature") AS average_temperature FROM temperature GROUP BY ALL""",
    # Balances have no digit below 2^-60: whole numbers, whose sum is rounded once.
    "avg_unrounded": """SELECT c_nationkey, (CAST(s // (1::HUGEINT << 40) AS DOUBLE) * pow(2, 40) + CAST(s % (1::HUGEINT << 40) AS DOUBLE))
  / pow(2, 60) / n AS average_balance
FROM (SELECT c_nationkey, sum(CAST(c_acctbal * pow(2, 60) AS HUGEINT)) AS s, count(c_acctbal) AS n FROM customer GROUP BY ALL)""",
    "preview": "SELECT * FROM orders ORDER BY o_orderkey LIMIT 5",
    "dedup_single_key": """SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS rn FROM documents) WHERE rn = 1""",
    "dedup_composite_key": _lines_by(["l_orderkey", "l_linenumber"]),
    "dedup_rare_keys": _lines_by(["l_partkey", "l_shipdate"]),
    "double_to_int": """SELECT c_custkey, TRY_CAST(trunc(c_acctbal) AS INT) AS balance,
  TRY_CAST(trunc(-c_acctbal) AS INT) AS negated,
  TRY_CAST(trunc(c_acctbal * 1e6) AS INT) AS overflowing,
  TRY_CAST(trunc(c_acctbal * 1e6) AS BIGINT) AS wide FROM customer""",
    "sas_date": """SELECT o_orderkey, DATE '1960-01-01' + n AS kept,
  DATE '1960-01-01' + nullif(n, 0) AS zero_null, DATE '1960-01-01' - n AS before_epoch
FROM (SELECT o_orderkey, CAST(date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) AS INT) AS n FROM orders)""",
    "sas_date_string": """SELECT o_orderkey, CAST(DATE '1960-01-01' + nullif(n, 0) AS VARCHAR) AS iso,
  CAST(DATE '1960-01-01' + n AS VARCHAR) AS iso_kept
FROM (SELECT o_orderkey, CAST(date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) AS INT) AS n FROM orders)""",
    "date_to_string": """SELECT o_orderkey, CAST(CAST(o_orderdate AS TIMESTAMP) AS VARCHAR) AS stamp,
  CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day FROM orders""",
    "title_case": "SELECT p_partkey, "
    + _title.format("upper(p_name) || '-' || lower(p_brand) || '-' || 'o''' || lower(p_type) || '-' || '(u.s.a.)'")
    + " AS titled FROM part",
    "calendar_parts": """SELECT o_orderkey, d AS day_of, CAST(day(d) AS INT) AS day, CAST(weekofyear(d) AS INT) AS week,
  CAST(month(d) AS INT) AS month, CAST(year(d) AS INT) AS year, CAST(dayofweek(d) + 1 AS INT) AS weekday
FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)""",
    "format_count": "SELECT o_orderkey, format('{:,}', o_orderkey * o_custkey) AS formatted FROM orders",
    "format_float": """SELECT o_orderkey, format('{:,}', o_totalprice) AS price,
  format('{:,}', -o_totalprice / 8) AS eighth FROM orders""",
    "dim_key_merge": """WITH half AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderkey <= (SELECT max(o_orderkey) // 2 FROM orders)),
kept AS (SELECT o_custkey, row_number() OVER (ORDER BY o_custkey) - 1 AS customer_key FROM half)
SELECT * FROM kept
UNION ALL SELECT o_custkey, (SELECT count(*) FROM kept) + row_number() OVER (ORDER BY o_custkey) - 1
FROM (SELECT DISTINCT o_custkey FROM orders WHERE o_custkey NOT IN (SELECT o_custkey FROM kept))""",
    "dim_surrogate_key": f"WITH {PRIORITY} SELECT * FROM priority",
    "dense_key_large": f"""SELECT row_number() OVER (ORDER BY {_last(
        ["l_orderkey", "l_partkey", "l_suppkey"]
        + [c for c in _line_columns if c not in ("l_orderkey", "l_partkey", "l_suppkey")]
    )}) - 1 AS id, l_orderkey, l_partkey, l_suppkey, l_linenumber FROM lineitem""",
    "calendar_dim": _calendar(_order_dates),
    "country_dim": f"WITH {ARRIVALS}, {TEMPERATURE} "
    + _country(_raw_codes, "temperature", "n.n_name", 'upper("Country")'),
    "country_dim_titled": f"WITH {ARRIVALS}, {TEMPERATURE} "
    + _country(_raw_codes, "temperature", _titled_nation, '"Country"'),
    "demographics_dim": f"""WITH {CITIES} SELECT "City", "State", "Median Age" AS median_age,
  "Male Population" AS male_population, "Female Population" AS female_population,
  "Total Population" AS total_population, "Number of Veterans" AS number_of_veterans,
  "Foreign-born" AS foreign_born, "Average Household Size" AS average_household_size,
  "State Code" AS state_code, "Race", "Count",
  row_number() OVER (ORDER BY {_last(["City", "State", "State Code", "Race"])}) - 1 AS id FROM cities""",
    "fact_dim_key": _fact("="),
    "fact_dim_key_nullsafe": _fact("IS NOT DISTINCT FROM"),
    "fact_dim_key_shuffled": _fact("="),
    "clean_arrivals": f"WITH {CLEANED} SELECT * FROM cleaned",
    "clean_arrivals_text_dates": f"""WITH {CLEANED} SELECT cicid,
  CAST(nullif(arrdate, DATE '1960-01-01') AS VARCHAR) AS arrdate,
  CAST(nullif(depdate, DATE '1960-01-01') AS VARCHAR) AS depdate, admnum, visatype FROM cleaned""",
    "clean_temperature": f"WITH {READINGS} SELECT * FROM readings",
    "clean_demographics": f"WITH {CITIES} SELECT * FROM cities",
    "quality_row_count": " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, count(*) AS row_count, {_status('count(*) > 0')} FROM {rel}"
        for n, rel in [
            ("orders", "orders"), ("lineitem", "lineitem"), ("customer", "customer"),
            ("none", "orders WHERE o_orderkey < 0"),
        ]
    ),
    "quality_duplicate_key": _unique_check("lineitem", "l_orderkey,l_linenumber")
    + " UNION ALL "
    + _unique_check("orders", "o_orderkey"),
    "quality_null_key": f"WITH {HOLEY}, {GAPS} "
    + " UNION ALL ".join(
        [
            _null_check("lineitem", "holey", "l_orderkey"),
            _null_check("lineitem", "holey", "l_returnflag"),
            _null_check("orders", "gaps", "o_orderkey"),
            _null_check("orders", "gaps", "o_orderpriority"),
        ]
    ),
    "star_checks": STAR_CHECKS,
    "star_fact": f"{STAR} SELECT * FROM fact",
    "star_increment": f"{STAR} SELECT f.* EXCLUDE (visa_type_key), v.visatype FROM fact f LEFT JOIN visatypes v USING (visa_type_key)",
    "star_increment_losses": LOSSES,
    "star_summary": SUMMARY,
    "star_summary_shuffled": SUMMARY,
    "star_year": f"SELECT * FROM ({SUMMARY}) WHERE arrival_year = 1995",
    "star_integrity": " UNION ALL ".join(
        f"SELECT 'lineitem' AS table_name, '{k}' AS column_name, count(*) AS orphans, {_status('count(*) = 0')} "
        f"FROM lineitem WHERE {k} NOT IN ({known})"
        for k, known in [
            ("l_partkey", "SELECT p_partkey FROM part WHERE p_size > 3"),
            ("l_orderkey", "SELECT o_orderkey FROM orders"),
        ]
    ),
}
