"""Column expressions. Everything here is a built-in Spark expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: SAS counts days from this date.
SAS_EPOCH = "1960-01-01"

# Day numbers of 0001-01-01 and 9999-12-31, between which dates can be shown.
SAS_FIRST, SAS_LAST = -715509, 2936549

# Fixed value: groups of three digits, at least one and at most 17 decimals.
GROUPED_DECIMALS = "#,##0.0################"


def column(name: str) -> Column:
    """A column by its exact name, also when the name holds dots or backticks."""
    return F.col("`" + name.replace("`", "``") + "`")


def is_missing(name: str, dtype: T.DataType) -> Column:
    """True for null and, in floating-point columns, for NaN.

    ``isnan`` is applied to float and double only: under ANSI rules it raises
    on text that is no number, and it has no meaning for dates.
    """
    c = column(name)
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def is_present(name: str, dtype: T.DataType) -> Column:
    """The opposite of :func:`is_missing`, as a conjunction.

    Written with ``isNotNull`` first so that the null part reaches the file
    scan as a pushed filter.
    """
    c = column(name)
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return c.isNotNull() & ~F.isnan(c)
    return c.isNotNull()


def truncate_to_int(c: Column, wide: bool = False) -> Column:
    """Number to integer, truncating toward zero.

    Null, NaN and values outside the target type give null. ``wide`` selects a
    64-bit target.
    """
    return c.try_cast("bigint" if wide else "int")


def sas_date(days: Column, zero_as_null: bool = False) -> Column:
    """SAS day number to date. Day 0 is the epoch unless ``zero_as_null``.

    Numbers before year 1 or after year 9999 give null.
    """
    n = truncate_to_int(days)
    n = F.when(n.between(SAS_FIRST, SAS_LAST), n)
    if zero_as_null:
        n = F.nullif(n, F.lit(0))
    return F.date_add(F.lit(SAS_EPOCH).cast("date"), n)


def sas_date_string(days: Column, zero_as_null: bool = True) -> Column:
    """SAS day number to ``yyyy-MM-dd`` text; day 0 gives null by default."""
    return sas_date(days, zero_as_null).cast("string")


def title_case(c: Column) -> Column:
    """Upper-case the first letter of every run of letters, lower-case the rest.

    ``initcap`` alone splits at blanks only (``Guinea-bissau``), so it is
    applied to each run of letters.
    """
    runs = F.regexp_extract_all(F.lower(c), F.lit(r"(\p{L}+|[^\p{L}]+)"), F.lit(1))
    return F.array_join(F.transform(runs, lambda run: F.initcap(run)), "")


def calendar_parts(date: Column, prefix: str = "") -> dict[str, Column]:
    """Day, ISO week, month, year and weekday (1 = Sunday) of a date.

    Week is the ISO week while year is the calendar year, so 2016-01-01 is
    week 53 of year 2016.
    """
    return {
        f"{prefix}day": F.dayofmonth(date),
        f"{prefix}week": F.weekofyear(date),
        f"{prefix}month": F.month(date),
        f"{prefix}year": F.year(date),
        f"{prefix}weekday": F.dayofweek(date),
    }


def format_count(n: Column) -> Column:
    """Whole number with thousands separators."""
    return F.format_number(n, 0)


def format_float(x: Column) -> Column:
    """Floating-point number with thousands separators and all its decimals.

    Numbers are written out in full, never with an exponent.
    """
    return F.call_function("format_number", x, F.lit(GROUPED_DECIMALS))
