"""Increments against a whole run over the same arrivals."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from portolan import plans, schemas, sinks
from portolan.plans import increment
from portolan.plans.layers import Layer, beyond, month_of, read_layers, within
from tests.test_plans import arrival, contents, demographics, mapping, temperature  # noqa: F401 (fixtures)

# Days since 1960 of the first of April, May and June 2016, and the same of July.
APRIL, MAY, JUNE, JULY = 20545.0, 20575.0, 20606.0, 20636.0


def rows(spark, *made):
    return spark.createDataFrame([arrival(k, arrdate=d, **v) for k, d, v in made], schemas.ARRIVALS)


@pytest.fixture
def days(spark):
    """Arrivals of three runs; records of the first come again in the others, in other months too."""
    first = rows(
        spark, (1, APRIL, {"visatype": "WT", "i94res": 8105.0}), (2, MAY, {"visatype": "B2"}), (3, JUNE, {"visatype": "WT"}),
        (4, JUNE, {"i94yr": 2017.0}), (float("nan"), MAY, {"i94yr": 2015.0}), (3, JUNE, {"visatype": "B2"}),
    )
    second = rows(
        spark, (5, JULY, {"visatype": "B1", "i94res": 8230.0}), (4, JULY, {"i94yr": 2016.0}), (4, None, {"i94yr": 2018.0}),
        (float("nan"), JULY, {"i94yr": 2014.0}), (1e300, JULY, {"i94yr": 2019.0}),
    )
    third = rows(spark, (6, None, {"visatype": "WT"}), (5, JULY, {"visatype": "A1", "i94res": 8230.0}), (7, 99999999.0, {}))
    return first, second, third


@pytest.mark.parametrize("max_layers", [1, 32])
def test_increments_equal_a_whole_run(spark, tmp_path, days, demographics, temperature, mapping, max_layers):  # noqa: F811
    others = (demographics.where("Race IS NOT NULL"), temperature, mapping)
    grown, whole = str(tmp_path / "grown"), str(tmp_path / "whole")
    release = sinks.Release(spark, grown)
    so_far, versions = None, []
    for i, day in enumerate(days):
        so_far = day if so_far is None else so_far.unionAll(day)
        plans.publish_increment(day, *others, grown, max_layers=max_layers, strict=False)
        versions.append(release.current())
        # keys stay in both, so they are given in the same order
        plans.publish_star(so_far, *others, whole, strict=False)
        star, want = plans.open_star(spark, grown), plans.open_star(spark, whole)
        assert contents(star) == contents(want), i
        assert sorted(map(repr, star.losses.collect())) == sorted(map(repr, want.losses.select(star.losses.columns).collect()))
        # lost record ids and codes fail both in the same way
        assert sorted(map(repr, star.checks.collect())) == sorted(map(repr, want.checks.collect()))
    layers = read_layers(release, versions[2])
    if max_layers == 1:
        # written as one again
        assert layers == [Layer(versions[2])] and release.prune(0) == versions[:2]
        assert contents(plans.open_star(spark, grown)) == contents(want)
        return
    july, june, may = 2016 * 12 + 6, 2016 * 12 + 5, 2016 * 12 + 4
    assert layers == [Layer(versions[0]), Layer(versions[1], frozenset({may, june, july})), Layer(versions[2], frozenset({0, july}))]
    # April was written once, and the versions that are read stay
    assert spark.read.parquet(f"{release.folder(versions[1])}/immigration_fact").where("arrdate < DATE'2016-05-01'").isEmpty()
    assert release.needs(versions[2]) == set(versions[:2]) and release.prune(0) == []
    with pytest.raises(ValueError, match="needed"):
        release.discard(versions[0])
    # a whole run lets them go
    plans.publish_star(so_far, *others, grown, strict=False)
    assert release.prune(0) == versions and contents(plans.open_star(spark, grown)) == contents(want)


def test_an_empty_or_failed_increment_changes_no_fact(spark, tmp_path, days, demographics, temperature, mapping, monkeypatch):  # noqa: F811
    others = (demographics.where("Race IS NOT NULL"), temperature, mapping)
    out = str(tmp_path / "out")
    plans.publish_star(days[0], *others, out, strict=False)
    before = contents(plans.open_star(spark, out))
    plans.publish_increment(days[0].limit(0), *others, out, strict=False)
    assert contents(plans.open_star(spark, out)) == before
    # the same arrivals again
    star = plans.publish_increment(days[0], *others, out, strict=False)
    assert contents(star) == before and star.losses.where("source = 'arrivals'").first().before == 12
    release = sinks.Release(spark, out)
    version = release.current()

    with pytest.raises(ValueError, match="not_null"):
        plans.publish_increment(days[1], *others, out)

    def dying(df, folder, name):
        raise RuntimeError(f"killed at {name}")

    monkeypatch.setattr(increment, "store_table", dying)
    with pytest.raises(RuntimeError, match="killed"):
        plans.publish_increment(days[1], *others, out)
    assert release.current() == version and contents(plans.open_star(spark, out)) == before
    with pytest.raises(ValueError, match="keys"):
        plans.run_etl(spark, "a", "b", "c", "d", out, keep_keys=False, increment=True)


def test_months(spark):
    dates = [dt.date(1, 1, 1), dt.date(1999, 12, 31), dt.date(2000, 1, 1), dt.date(2000, 2, 29), dt.date(2000, 3, 1), dt.date(9999, 12, 31), None]
    df = spark.createDataFrame([(d,) for d in dates], "d date").withColumn("m", month_of(F.col("d")))
    all_months = [r.m for r in df.collect()]
    assert all_months == [12, 1999 * 12 + 11, 2000 * 12, 2000 * 12 + 1, 2000 * 12 + 2, 9999 * 12 + 11, 0]
    for chosen in ([], all_months, all_months[1:4], [0], [0, 2000 * 12 + 1], [12, 9999 * 12 + 11], [2000 * 12 + 6]):
        inside = {r.d for r in df.where(within(F.col("d"), chosen)).collect()}
        assert inside == {d for d, m in zip(dates, all_months) if m in chosen}
        outside = {r.d for r in df.where(beyond(F.col("d"), chosen)).collect()}
        assert outside == set(dates) - inside


def test_replaced_months_are_left_out_by_the_scan(spark, tmp_path):
    lines = spark.range(100_000).selectExpr("date_add(DATE'2000-01-01', CAST(id % 900 AS INT)) AS arrdate", "id AS record_id")
    sinks.write_parquet(lines, str(tmp_path / "f"), order_by=["arrdate", "record_id"])
    plan = spark.read.parquet(str(tmp_path / "f")).where(beyond(F.col("arrdate"), [2000 * 12 + 1, 2000 * 12 + 2]))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Or(LessThan(arrdate,2000-02-01),GreaterThan(arrdate,2000-03-31))" in text
