"""A fact table in layers, each of which replaces whole months of those below it.

The lowest layer is the fact of a whole run. An increment writes only the
months that it touches, into a folder of its own version; the other months
are read from where they are. All layers are in the order of dates, so a
month that a later layer replaces is left out by files and row groups.
"""

from __future__ import annotations

import calendar
import dataclasses
import datetime
import functools
import operator
from collections.abc import Collection, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from portolan.sinks import Release, path_exists, write_parquet
from portolan.sources import load_table

LAYERS = "fact_layers"
# Stands for the months of rows without a date.
UNDATED = 0


@dataclasses.dataclass(frozen=True)
class Layer:
    """The fact of a version, and the months in which it replaces earlier ones."""

    version: str
    months: frozenset[int] = frozenset()


def month_of(date: Column) -> Column:
    """Months since the year 0; ``UNDATED`` for null."""
    return F.coalesce(F.year(date) * 12 + F.month(date) - 1, F.lit(UNDATED))


def _spans(months: Iterable[int]) -> list[tuple[datetime.date, datetime.date]]:
    """First and last day of every run of neighbouring months."""
    runs: list[list[int]] = []
    for m in sorted(set(months) - {UNDATED}):
        if runs and runs[-1][1] == m - 1:
            runs[-1][1] = m
        else:
            runs.append([m, m])
    ends = [(last // 12, last % 12 + 1) for _, last in runs]
    return [
        (datetime.date(first // 12, first % 12 + 1, 1), datetime.date(year, month, calendar.monthrange(year, month)[1]))
        for (first, _), (year, month) in zip(runs, ends)
    ]


def _day(day: datetime.date) -> Column:
    # As text: a date before the year 1000 does not pass to Spark otherwise.
    return F.lit(day.isoformat()).cast("date")


def within(date: Column, months: Collection[int]) -> Column:
    """Whether a date lies in one of the months, as comparisons that reach the scan."""
    parts = [date.between(_day(a), _day(b)) for a, b in _spans(months)]
    if UNDATED in months:
        parts.append(date.isNull())
    return functools.reduce(operator.or_, parts, F.lit(False))


def beyond(date: Column, months: Collection[int]) -> Column:
    """Whether a date lies in none of the months, likewise."""
    outside = [(date < _day(a)) | (date > _day(b)) for a, b in _spans(months)]
    dated = functools.reduce(operator.and_, outside, date.isNotNull())
    return dated if UNDATED in months else dated | date.isNull()


def read_layers(release: Release, version: str) -> list[Layer]:
    """The layers of a version's fact, the lowest first."""
    path = f"{release.folder(version)}/{LAYERS}"
    if not path_exists(release.spark, path):
        return [Layer(version)]
    # A row per layer: at most as many as an increment lets there be.
    rows = load_table(release.spark, path).orderBy("layer").collect()
    return [Layer(r.version, frozenset(r.months)) for r in rows]


def write_layers(release: Release, version: str, layers: list[Layer]) -> None:
    rows = [(i, layer.version, sorted(layer.months)) for i, layer in enumerate(layers)]
    frame = release.spark.createDataFrame(rows, "layer int, version string, months array<int>")
    write_parquet(frame.coalesce(1), f"{release.folder(version)}/{LAYERS}")


def read_fact(release: Release, version: str, layers: list[Layer] | None = None) -> DataFrame:
    """The fact of a version; of every month the rows of the last layer that has it."""
    replaced: set[int] = set()
    parts = []
    for layer in reversed(layers or read_layers(release, version)):
        rows = load_table(release.spark, f"{release.folder(layer.version)}/immigration_fact")
        parts.append(rows.where(beyond(F.col("arrdate"), replaced)) if replaced else rows)
        replaced |= layer.months
    return functools.reduce(DataFrame.unionByName, parts)
