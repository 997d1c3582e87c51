import datetime as dt
import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from portolan import functions as fx


def values(spark, schema, rows, **columns):
    df = spark.createDataFrame([(r,) for r in rows], schema)
    out = df.select(*[c.alias(n) for n, c in columns.items()]).collect()
    return [tuple(r) if len(r) > 1 else r[0] for r in out]


def test_truncation_is_toward_zero_and_safe(spark):
    rows = [1.9, -1.9, 0.0, None, math.nan, math.inf, 92468461630.0, -2147483648.0]
    got = values(
        spark, "x double", rows, n=fx.truncate_to_int(F.col("x")), w=fx.truncate_to_int(F.col("x"), wide=True)
    )
    assert got == [
        (1, 1),
        (-1, -1),
        (0, 0),
        (None, None),
        (None, None),
        (None, None),
        (None, 92468461630),
        (-2147483648, -2147483648),
    ]


def test_sas_dates(spark):
    rows = [0.0, 20574.0, -1.0, None]
    got = values(
        spark,
        "x double",
        rows,
        kept=fx.sas_date(F.col("x")),
        dropped=fx.sas_date(F.col("x"), zero_as_null=True),
        text=fx.sas_date_string(F.col("x")),
    )
    assert got == [
        (dt.date(1960, 1, 1), None, None),
        (dt.date(2016, 4, 30), dt.date(2016, 4, 30), "2016-04-30"),
        (dt.date(1959, 12, 31), dt.date(1959, 12, 31), "1959-12-31"),
        (None, None, None),
    ]


# A hyphen, a comma, brackets, dots, quotes, digits first, blanks, nothing, letters beyond ASCII.
NAMES = ["on-off", "left, right", "f(x, y) = z", "e.g. this", "it's", '"so"', "7up", "x2y", "  wide   gap ", "", "straße", "ñandú", "ALL CAPS"]


def test_title_case_follows_letter_runs(spark):
    assert values(spark, "s string", NAMES + [None], t=fx.title_case(F.col("s"))) == [
        n.title() for n in NAMES
    ] + [None]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="abzABZ019 .,-'()&:", max_size=20), min_size=1, max_size=20))
def test_title_case_equals_python_on_ascii(spark, names):
    assert values(spark, "s string", names, t=fx.title_case(F.col("s"))) == [n.title() for n in names]


def test_calendar_parts_mix_iso_week_and_calendar_year(spark):
    days = [dt.date(2016, 1, 1), dt.date(2016, 4, 30), dt.date(2015, 12, 31), None]
    got = values(spark, "d date", days, **fx.calendar_parts(F.col("d")))
    # day, week, month, year, weekday (1 = Sunday)
    assert got == [(1, 53, 1, 2016, 6), (30, 17, 4, 2016, 7), (31, 53, 12, 2015, 5), (None,) * 5]


def test_format_count(spark):
    got = values(spark, "n bigint", [0, 999, 1000, -1234567, None], s=fx.format_count(F.col("n")))
    assert got == ["0", "999", "1,000", "-1,234,567", None]


def test_format_float(spark):
    rows = [0.0, 1.5, -1234567.891, 1000.0, 123456789012.34, 0.30000000000000004, 12345678.0]
    got = values(spark, "x double", rows + [None], s=fx.format_float(F.col("x")))
    assert got == ["{:,}".format(x) for x in rows] + [None]


def test_missing_looks_for_nan_in_numbers_only(spark):
    df = spark.createDataFrame(
        [(math.nan, "nan", dt.date(2020, 1, 1)), (1.0, None, None), (None, "x", None)],
        "`a.b` double, s string, d date",
    )
    types = {f.name: f.dataType for f in df.schema}
    rows = df.select(*[fx.is_missing(n, t) for n, t in types.items()]).collect()
    assert [tuple(r) for r in rows] == [(True, False, False), (False, True, True), (True, False, True)]
    rows = df.select(*[fx.is_present(n, t) for n, t in types.items()]).collect()
    assert [tuple(r) for r in rows] == [(False, True, True), (True, False, False), (False, True, False)]


def test_column_takes_names_literally(spark):
    df = spark.createDataFrame([(1, 2)], "`a.b` int, `c``d` int")
    assert df.select(fx.column("a.b"), fx.column("c`d")).first() == (1, 2)


@pytest.mark.parametrize("name", ["Median Age", "Foreign-born"])
def test_column_with_blank_or_hyphen(spark, name):
    df = spark.createDataFrame([(1,)], f"`{name}` int")
    assert df.select(fx.column(name)).first()[0] == 1
