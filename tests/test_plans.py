"""Recipes, dimensions, fact and the whole job on small made tables."""

import dataclasses
import datetime as dt
import math
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from portolan import operators as ops
from portolan import plans, schemas, sinks
from portolan.__main__ import main
from portolan.operators import raise_on_failure
from portolan.plans import etl
from portolan.plans.etl import loss_report
from portolan.sinks import write_parquet


def tuples(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


ARRIVAL_COLUMNS = [c.split()[0] for c in schemas.ARRIVALS.replace("\n", " ").split(",")]


def arrival(cicid, **values):
    base = dict.fromkeys(ARRIVAL_COLUMNS)
    base |= {"cicid": float(cicid), "i94yr": 2016.0, "i94mon": 4.0, "count": 1.0, "arrdate": 20574.0}
    return tuple((base | values).values())


@pytest.fixture
def arrivals(spark):
    rows = [
        arrival(1, i94res=8105.0, visatype="WT", i94addr="NY", depdate=20580.0, admnum=92468461630.0),
        arrival(1, i94res=8105.0, visatype="WT", i94addr="NY", depdate=20580.0, admnum=92468461631.0),
        arrival(2, i94res=8230.0, visatype="B2", arrdate=0.0, i94bir=-3.9),
        arrival(3, i94res=999.0, visatype=None, arrdate=-1.0, i94bir=math.nan),
        arrival(4, i94res=8340.0, visatype="WT", arrdate=None, occup="x"),
        arrival(5, i94res=None, visatype="B1", arrdate=20454.0),
    ]
    return spark.createDataFrame(rows, schemas.ARRIVALS)


@pytest.fixture
def temperature(spark):
    day = dt.date(1743, 11, 1)
    rows = [
        (day, 6.0, 1.7, "Mirren", "Pelm", "40N", "20E"),
        (day, 7.0, 1.7, "Mirren", "Pelm", "41N", "20E"),
        (day, 10.0, 1.7, "Lowport", "Pelm", "41N", "19E"),
        (day, None, None, "Dunham", "Quill", "34N", "69E"),
        (day, math.nan, None, "Estwick", "Quill", "34N", "62E"),
        (day, -2.0, 1.0, "Brimley", "Lee-On-Sea", "11N", "15W"),
    ]
    return spark.createDataFrame(rows, schemas.TEMPERATURE)


@pytest.fixture
def demographics(spark):
    def city(name, race, size=2.5, men=10, age=30.0):
        return (name, "Ohio", age, men, 11, 21, 3, 4, size, "OH", race, 5)

    rows = [
        city("Akron", "White"),
        city("Akron", "White", age=29.0),
        city("Akron", "Asian"),
        city("Parma", "White", men=None),
        city("Parma", "Asian", size=math.nan),
        city("Xenia", "White"),
    ]
    return spark.createDataFrame(rows, schemas.DEMOGRAPHICS)


@pytest.fixture
def mapping(spark):
    return spark.createDataFrame(
        [(8105, "PELM"), (8230, "QUILL"), (8340, "LEE-ON-SEA"), (0, "ISLET NINE")], schemas.MAPPING
    )


def test_clean_arrivals(arrivals):
    for rare in (False, True):
        out = plans.clean_arrivals(arrivals, rare_duplicates=rare)
        types = dict(out.dtypes)
        assert not set(schemas.SPARSE_ARRIVALS) & set(types)
        assert types["arrdate"] == types["depdate"] == "date"
        assert types["admnum"] == types["cicid"] == "bigint" and types["i94res"] == "int"
        rows = {r.cicid: r for r in out.collect()}
        assert sorted(rows) == [1, 2, 3, 4, 5] and out.count() == 5
        assert rows[1].admnum == 92468461630 and rows[1].depdate == dt.date(2016, 5, 6)
        assert rows[2].arrdate == dt.date(1960, 1, 1) and rows[2].i94bir == -3
        assert rows[3].arrdate == dt.date(1959, 12, 31) and rows[3].i94bir is None
        assert rows[4].arrdate is None


def test_clean_arrivals_options(arrivals):
    out = plans.clean_arrivals(arrivals, drop=[], wide=[], zero_as_null=True, as_string=True)
    rows = {r.cicid: r for r in out.collect()}
    assert rows[1].arrdate == "2016-04-30" and rows[2].arrdate is None and rows[3].arrdate == "1959-12-31"
    assert rows[1].admnum is None and rows[4].occup == "x"


def test_clean_temperature(temperature):
    out = plans.clean_temperature(temperature)
    assert [(r[0], r[1], r[3]) for r in tuples(out)] == [
        ("1743-11-01", -2.0, "Brimley"),
        ("1743-11-01", 10.0, "Lowport"),
        ("1743-11-01", 6.0, "Mirren"),
    ]
    assert dict(plans.clean_temperature(temperature, date_as_string=False).dtypes)["dt"] == "date"


def test_clean_demographics(demographics):
    out = plans.clean_demographics(demographics)
    assert sorted((r[0], r[10], r[2]) for r in out.collect()) == [
        ("Akron", "Asian", 30.0),
        ("Akron", "White", 29.0),
        ("Xenia", "White", 30.0),
    ]


def test_loss_report(arrivals, demographics, temperature):
    assert tuples(loss_report(arrivals, demographics, temperature)) == [
        ("arrivals", 6, 0, 1, 5, 0, 0),
        ("demographics", 6, 2, 1, 3, 0, 0),
        ("temperature", 6, 2, 1, 3, 0, 0),
    ]


def test_keys_are_compared_after_retyping(spark):
    rows = [arrival(x, arrdate=d) for x, d in [(1.2, 5.0), (1.7, 99999999.0), (1e300, 5.0), (1e301, 5.0), (math.nan, 5.0), (2.0, -2147483648.0)]]
    df = spark.createDataFrame(rows, schemas.ARRIVALS)
    for rare in (False, True):
        out = plans.clean_arrivals(df, rare_duplicates=rare).collect()
        assert sorted((r.cicid is not None, r.cicid) for r in out) == [(False, None), (True, 1), (True, 2)]
        assert {r.cicid: r.arrdate for r in out}[2] is None
    report = {r.source: r for r in loss_report(df, spark.createDataFrame([], schemas.DEMOGRAPHICS), spark.createDataFrame([], schemas.TEMPERATURE)).collect()}
    assert (report["arrivals"].nulled_keys, report["arrivals"].nulled_values) == (2, 4)
    assert report["arrivals"].after == 3 and report["demographics"].before == 0


def test_key_dimension_keeps_null_as_last_row(arrivals):
    dim = plans.build_key_dimension(arrivals, "visatype", "visa_type_key")
    assert tuples(dim) == [("B1", 0), ("B2", 1), ("WT", 2), (None, 3)]


def test_calendar_dimension(arrivals):
    dim = plans.build_calendar_dimension(plans.clean_arrivals(arrivals))
    assert sorted(map(tuple, dim.collect()), key=lambda r: r[-1]) == [
        (dt.date(1959, 12, 31), 31, 53, 12, 1959, 5, 0),
        (dt.date(1960, 1, 1), 1, 53, 1, 1960, 6, 1),
        (dt.date(2016, 1, 1), 1, 53, 1, 2016, 6, 2),
        (dt.date(2016, 4, 30), 30, 17, 4, 2016, 7, 3),
        (None, None, None, None, None, None, 4),
    ]


def test_country_dimension(arrivals, mapping, temperature):
    readings = plans.clean_temperature(temperature)
    dim = plans.build_country_dimension(plans.clean_arrivals(arrivals), mapping, readings)
    assert tuples(dim) == [
        (8105, "Pelm", 8.0),
        (8230, "Quill", None),
        (8340, "Lee-On-Sea", -2.0),
        (999, None, None),
        (None, None, None),
    ]
    raw = plans.build_country_dimension(plans.clean_arrivals(arrivals), mapping, readings, titled=False)
    assert tuples(raw)[:3] == [(8105, "PELM", None), (8230, "QUILL", None), (8340, "LEE-ON-SEA", None)]


def test_country_dimension_with_repeated_mapping_rows(spark, arrivals, temperature):
    twice = spark.createDataFrame(
        [(8105, "PELM"), (8105, "PELM"), (8105, "ZPELM")], schemas.MAPPING
    )
    dim = plans.build_country_dimension(plans.clean_arrivals(arrivals), twice, temperature)
    # the first name in alphabetical order counts
    assert [r for r in tuples(dim) if r[0] == 8105] == [(8105, "Pelm", 23 / 3)]


def test_failed_job_leaves_no_staged_tables(spark, tmp_path, arrivals, demographics, temperature):
    root = Path(spark.conf.get("spark.checkpoint.dir")) / "portolan"
    before = set(root.glob("*"))
    with pytest.raises(Exception):
        plans.build_star(arrivals, demographics, temperature, spark.range(1), str(tmp_path / "out"))
    assert set(root.glob("*")) == before


def test_job_by_shuffle_leaves_no_staged_tables(spark, tmp_path, arrivals, demographics, temperature, mapping):
    root = Path(spark.conf.get("spark.checkpoint.dir")) / "portolan"
    before = set(root.glob("*"))
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        star = plans.build_star(arrivals, demographics, temperature, mapping, str(tmp_path / "out"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    assert {r.record_id: r.visa_type_key for r in star.immigration_fact.collect()} == {1: 2, 2: 1, 3: None, 4: 2, 5: 0}
    assert set(root.glob("*")) == before


def test_calendar_of_timestamps_and_of_a_dynamic_session(spark, tmp_path, arrivals):
    stamps = spark.sql("SELECT timestamp_seconds(id * 3600) AS arrdate FROM range(50)")
    assert plans.build_calendar_dimension(stamps).count() == 50
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        calendar = plans.build_calendar_dimension(plans.clean_arrivals(arrivals))
        for df in (calendar, calendar.where("id = 0")):
            write_parquet(df, str(tmp_path / "t"), schemas.CALENDAR_PARTITIONS, small_folders=True)
        assert spark.read.parquet(str(tmp_path / "t")).count() == 1
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")


def test_demographics_dimension(demographics):
    dim = plans.build_demographics_dimension(plans.clean_demographics(demographics))
    assert dim.columns == [
        "City", "State", "median_age", "male_population", "female_population", "total_population",
        "number_of_veterans", "foreign_born", "average_household_size", "state_code", "Race", "Count", "id",
    ]
    assert [(r.City, r.Race, r.id) for r in sorted(dim.collect(), key=lambda r: r.id)] == [
        ("Akron", "Asian", 0),
        ("Akron", "White", 1),
        ("Xenia", "White", 2),
    ]


@pytest.mark.parametrize("limit", [None, 0])
def test_fact(arrivals, limit):
    cleaned = plans.clean_arrivals(arrivals)
    visatype = plans.build_key_dimension(cleaned, "visatype", "visa_type_key")
    fact = plans.build_fact(cleaned, visatype, limit=limit)
    assert {"record_id", "country_residence_code", "state_code", "visa_type_key"} <= set(fact.columns)
    assert not {"cicid", "i94res", "i94addr", "visatype"} & set(fact.columns)
    assert dict(fact.dtypes)["visa_type_key"] == "bigint"
    keys = {r.record_id: r.visa_type_key for r in fact.collect()}
    assert keys == {1: 2, 2: 1, 3: None, 4: 2, 5: 0}
    safe = plans.build_fact(cleaned, visatype, null_safe=True, limit=limit)
    assert {r.record_id: r.visa_type_key for r in safe.collect()} == keys | {3: 3}


CHECKS = [
    ("not_empty", "country", "", 5, "PASS"),
    ("not_empty", "demographics", "", 3, "PASS"),
    ("not_empty", "immigration_fact", "", 5, "PASS"),
    ("not_empty", "immigration_time", "", 5, "PASS"),
    ("not_empty", "visatype", "", 4, "PASS"),
    ("not_null", "country", "country_code", 1, "FAIL"),
    ("not_null", "demographics", "City", 0, "PASS"),
    ("not_null", "demographics", "state_code", 0, "PASS"),
    ("not_null", "immigration_fact", "record_id", 0, "PASS"),
    ("not_null", "immigration_time", "arrdate", 1, "FAIL"),
    ("not_null", "visatype", "visa_type_key", 0, "PASS"),
    ("unique", "country", "country_code", 0, "PASS"),
    ("unique", "demographics", "id", 0, "PASS"),
    ("unique", "demographics", "City,State,state_code,Race", 0, "PASS"),
    ("unique", "immigration_fact", "record_id", 0, "PASS"),
    ("unique", "immigration_time", "arrdate", 0, "PASS"),
    ("unique", "visatype", "visatype", 0, "PASS"),
    ("references", "immigration_fact", "country_residence_code", 0, "PASS"),
    ("references", "immigration_fact", "arrdate", 0, "PASS"),
    ("references", "immigration_fact", "visa_type_key", 0, "PASS"),
    ("complete", "country", "", 0, "PASS"),
    ("complete", "demographics", "", 0, "PASS"),
    ("complete", "immigration_fact", "", 0, "PASS"),
    ("complete", "immigration_time", "", 0, "PASS"),
    ("unique", "immigration_time", "id", 0, "PASS"),
    ("unique", "visatype", "visa_type_key", 0, "PASS"),
]


def test_whole_job(spark, tmp_path, arrivals, demographics, temperature, mapping):
    star = plans.build_star(arrivals, demographics, temperature, mapping, str(tmp_path / "out"))
    assert tuples(plans.check_star(star)) == sorted(CHECKS, key=repr)
    # half of the fact is missing, and a dimension too
    torn = dataclasses.replace(
        star, immigration_fact=star.immigration_fact.where("record_id < 3"), visatype=star.visatype.where("visatype = 'B2'")
    )
    failed = {tuple(r)[:4] for r in plans.check_star(torn).where("status = 'FAIL'").collect()}
    assert ("complete", "immigration_fact", "", 3) in failed
    assert ("references", "immigration_fact", "visa_type_key", 1) in failed
    with pytest.raises(ValueError, match="arrdate"):
        raise_on_failure(plans.check_star(star))
    assert sorted(p.name for p in (tmp_path / "out").iterdir()) == [
        "cleaning_losses", "country", "demographics", "immigration_fact", "immigration_time", "visatype",
    ]
    folders = {p.relative_to(tmp_path / "out" / "immigration_time").as_posix()
               for p in (tmp_path / "out" / "immigration_time").glob("*/*/*")}
    assert "arrival_year=2016/arrival_month=4/arrival_week=17" in folders
    for frame in star.named().values():
        # folder columns are not part of the files, hence have no comment
        assert all(f.metadata["comment"] for f in frame.schema if f.name not in schemas.CALENDAR_PARTITIONS)

    summary = plans.star_summary(star.immigration_fact, star.country, star.immigration_time, star.visatype)
    assert tuples(summary) == sorted([
        ("Quill", 1960, 1, "B2", 1, None),
        ("Pelm", 2016, 2, "WT", 1, 8.0),
        ("Lee-On-Sea", None, 2, "WT", 1, -2.0),
        (None, 1959, None, None, 1, None),
        (None, 2016, 0, "B1", 1, None),
    ], key=repr)
    tables = star.immigration_fact, star.country, star.immigration_time, star.visatype
    assert tuples(plans.star_summary(*tables, years=(1959, 1960))) == sorted(
        [r for r in tuples(summary) if r[1] in (1959, 1960)], key=repr
    )
    assert plans.star_summary(*tables, years=(1800, 1801)).count() == 0
    # a second run replaces the first
    again = plans.build_star(arrivals.where("cicid < 3"), demographics, temperature, mapping, str(tmp_path / "out"))
    assert again.immigration_fact.count() == 2 and again.visatype.count() == 2


def test_a_range_of_dates_reads_few_row_groups(spark, tmp_path):
    """A third of the rows have one date; it is cut over files, the others lie apart."""
    rows = spark.range(0, 9000, 1, 6).select(
        F.col("id").alias("record_id"),
        F.when(F.col("id") % 3 == 0, "2016-05-05").otherwise(F.concat(F.lit("20"), F.lpad((F.col("id") % 60).cast("string"), 2, "0"), F.lit("-01-01"))).alias("arrdate"),
    )
    path = str(tmp_path / "fact")
    merge = "spark.sql.adaptive.coalescePartitions.enabled"  # else these few rows are one task
    spark.conf.set(merge, "false")
    sinks.write_parquet(rows, path, order_by=["arrdate", "record_id"])
    spark.conf.unset(merge)
    stored = spark.read.parquet(path)
    assert tuples(stored) == tuples(rows)
    found = stored.where(F.col("arrdate").between("2041-01-01", "2041-12-31"))
    assert "GreaterThanOrEqual(arrdate,2041-01-01)" in found._jdf.queryExecution().executedPlan().toString()
    groups = []
    for file in Path(path).glob("*.parquet"):
        meta = pq.ParquetFile(file).metadata
        groups += [(s.min, s.max, meta.num_rows) for s in (meta.row_group(i).column(1).statistics for i in range(meta.num_row_groups))]
    assert len(groups) >= 4 and sum(a <= "2041-12-31" and b >= "2041-01-01" for a, b, _ in groups) <= 2
    assert sum(a <= "2016-05-05" <= b for a, b, _ in groups) >= 2 and max(n for *_, n in groups) < 4500
    with pytest.raises(ValueError):
        sinks.write_parquet(rows, path, partition_by=["arrdate"], order_by=["record_id"])


@pytest.mark.parametrize("infer", [False, True])
def test_job_from_files_by_command_line(spark, tmp_path, arrivals, demographics, temperature, mapping, capfd, infer):
    def csv(df, name, sep):
        df.coalesce(1).write.option("header", True).option("sep", sep).csv(str(tmp_path / name))
        return str(tmp_path / name)

    arrivals.write.parquet(str(tmp_path / "arrivals"))
    args = [
        "--arrivals", str(tmp_path / "arrivals"),
        "--demographics", csv(demographics.where("Race IS NOT NULL"), "cities", ";"),
        "--temperature", csv(temperature, "temps", ","),
        "--mapping", csv(mapping, "codes", ","),
        "--output", str(tmp_path / "out"),
    ] + (["--infer"] if infer else [])
    with pytest.raises(ValueError, match="data quality"):  # a record without a key
        main(args)
    with pytest.raises(ValueError, match="published"):
        plans.open_star(spark, str(tmp_path / "out"))
    main(args + ["--lenient"])
    assert "immigration_fact" in capfd.readouterr().out
    star = plans.open_star(spark, str(tmp_path / "out"))
    assert star.immigration_fact.count() == 5 and star.demographics.count() == 3
    assert star.checks.where("status = 'FAIL'").count() > 0
    main(args + ["--lenient", "--keep", "0"])
    assert len(sinks.Release(spark, str(tmp_path / "out")).versions()) == 1


def test_job_from_the_csv_sample(spark, tmp_path, arrivals, demographics, temperature, mapping):
    sample = arrivals.selectExpr("row_number() OVER (ORDER BY cicid, admnum) AS `_c0`", "*")
    sample.toPandas().rename(columns={"_c0": ""}).to_csv(tmp_path / "sample.csv", index=False)
    for name, df, sep in [("d", demographics, ";"), ("t", temperature, ","), ("m", mapping, ",")]:
        df.write.option("header", True).option("sep", sep).csv(str(tmp_path / name))
    star = plans.run_etl(
        spark,
        str(tmp_path / "sample.csv"),
        str(tmp_path / "d"),
        str(tmp_path / "t"),
        str(tmp_path / "m"),
        str(tmp_path / "out"),
        arrivals_format="csv",
        strict=False,
    )
    assert star.immigration_fact.count() == 5 and "_c0" not in star.immigration_fact.columns
    assert tuples(star.visatype) == [("B1", 0), ("B2", 1), ("WT", 2), (None, 3)]


# ---------------------------------------------------------------- publication


@pytest.fixture
def sound(arrivals, demographics, temperature, mapping):
    """Sources whose star passes all checks."""
    return arrivals.where("cicid < 4"), demographics.where("Race IS NOT NULL"), temperature, mapping


def contents(star):
    return {name: sorted(map(repr, df.collect())) for name, df in star.named().items()}


def test_a_star_is_published_only_if_its_checks_pass(spark, tmp_path, sound, arrivals):
    out = str(tmp_path / "out")
    first = plans.publish_star(*sound, out)
    assert first.checks.where("status = 'FAIL'").isEmpty()
    before, version = contents(plans.open_star(spark, out)), sinks.Release(spark, out).current()
    empty = (arrivals.where("cicid < 0"), *sound[1:])
    with pytest.raises(ValueError, match="not_empty"):
        plans.publish_star(*empty, out)
    release = sinks.Release(spark, out)
    assert release.current() == version and contents(plans.open_star(spark, out)) == before
    # what failed is there to be looked at
    failed = [v for v in release.versions() if v != version]
    assert len(failed) == 1 and not plans.open_star(spark, out, failed[0]).checks.where("status = 'FAIL'").isEmpty()
    second = plans.publish_star(*empty, out, strict=False)
    assert release.current() not in (version, failed[0]) and second.immigration_fact.count() == 0
    assert contents(first) == before  # a reader of the old version keeps its tables


def test_a_run_that_dies_between_two_tables_changes_nothing(spark, tmp_path, sound, monkeypatch):
    out = str(tmp_path / "out")
    plans.publish_star(*sound, out)
    before = contents(plans.open_star(spark, out))
    written, write = [], etl.write_parquet

    def dying(df, path, *args, **kwargs):
        if path.endswith("/immigration_fact"):
            raise RuntimeError("killed")
        written.append(path)
        write(df, path, *args, **kwargs)

    monkeypatch.setattr(etl, "write_parquet", dying)
    with pytest.raises(RuntimeError, match="killed"):
        plans.publish_star(sound[0].where("cicid < 3"), *sound[1:], out)
    assert any(p.endswith("/visatype") for p in written)
    monkeypatch.undo()
    assert contents(plans.open_star(spark, out)) == before
    release = sinks.Release(spark, out)
    assert len(release.versions()) == 2 and release.prune(0) == []
    plans.publish_star(*sound, out)
    assert len(release.prune(1)) == 1 and len(release.prune(0)) == 1 and release.versions() == [release.current()]
    with pytest.raises(ValueError, match="published"):
        release.discard(release.current())


def test_pointers_that_name_nothing_are_refused(spark, tmp_path):
    release = sinks.Release(spark, str(tmp_path / "out"))
    assert release.current() is None and release.versions() == []
    for name in ("../elsewhere", release.new()):
        with pytest.raises(ValueError):
            release.publish(name)
    (tmp_path / "out").mkdir()
    (tmp_path / "out" / "CURRENT").write_text("../elsewhere")
    with pytest.raises(ValueError, match="names no version"):
        release.current()


def test_keys_stay_from_run_to_run(spark, tmp_path, sound):
    out = str(tmp_path / "out")
    some, *others = sound
    first = plans.publish_star(some.where("visatype = 'WT'"), *others, out)
    old = {"visa": dict(tuples(first.visatype)), "day": {r.arrdate: r.id for r in first.immigration_time.collect()}}
    second = plans.publish_star(*sound, out)
    new = {"visa": dict(tuples(second.visatype)), "day": {r.arrdate: r.id for r in second.immigration_time.collect()}}
    for name in old:
        assert old[name].items() <= new[name].items() and sorted(new[name].values()) == list(range(len(new[name])))
    assert len(new["visa"]) > len(old["visa"]) and new["visa"]["WT"] == 0
    assert second.checks.where("status = 'FAIL'").isEmpty()
    third = plans.publish_star(*sound, out, keep_keys=False)
    assert dict(tuples(third.visatype))["B2"] == 0
    # values that are gone keep their rows; the fact of the earlier version still finds them
    fourth = plans.publish_star(some.where("visatype <> 'WT'"), *others, out)
    assert dict(tuples(fourth.visatype)) == dict(tuples(third.visatype))
    assert fourth.checks.where("status = 'FAIL'").isEmpty()


def test_lines_that_cannot_be_read_are_set_aside_and_counted(spark, tmp_path, arrivals, demographics, temperature, mapping):
    sample = arrivals.where("cicid < 4").selectExpr("row_number() OVER (ORDER BY cicid, admnum) AS `_c0`", "*")
    sample.toPandas().rename(columns={"_c0": ""}).to_csv(tmp_path / "sample.csv", index=False)
    with open(tmp_path / "sample.csv", "a") as f:
        f.write("9,not a number" + "," * 27 + "\n9,too,short\n")
    demographics.where("Race IS NOT NULL").write.option("header", True).option("sep", ";").csv(str(tmp_path / "d"))
    (tmp_path / "d" / "more.csv").write_text(";".join(demographics.columns) + "\nLima;Ohio;old;1;2;3;4;5;6;OH;White;9\n")
    temperature.write.option("header", True).csv(str(tmp_path / "t"))
    mapping.write.option("header", True).csv(str(tmp_path / "m"))
    args = [spark, *(str(tmp_path / n) for n in ("sample.csv", "d", "t", "m", "out"))]
    with pytest.raises(Exception, match="(?i)malformed"):
        plans.run_etl(*args, arrivals_format="csv")
    with pytest.raises(ValueError, match="schema"):
        plans.run_etl(*args, arrivals_format="csv", infer=True, rejects=True)
    plans.run_etl(*args, arrivals_format="csv", rejects=True)
    star = plans.open_star(spark, str(tmp_path / "out"))
    assert {r.source: r.rejected for r in star.losses.collect()} == {"arrivals": 2, "demographics": 1, "temperature": 0}
    bad = {(r.source, tuple(r.bad_columns)) for r in star.rejects.collect()}
    assert bad >= {("arrivals", ("cicid",)), ("demographics", ("Median Age",))} and star.rejects.count() == 3
    assert star.immigration_fact.count() == 3


def test_merged_dimension(spark):
    stored = spark.createDataFrame([("b", None, 4, "old"), (None, "x", 7, "old"), ("z", "z", 0, "old")], "p string, q string, key long, note string")
    new = spark.createDataFrame([("b", None, "new"), (None, None, "new"), ("a", "a", "new"), (None, "x", "new"), ("c", None, "new")], "p string, q string, note string")
    want = [("a", "a", "new", 8), ("b", None, "new", 4), ("c", None, "new", 9), ("z", "z", "old", 0), (None, None, "new", 10), (None, "x", "new", 7)]
    for small in (0, 1000):
        out = ops.merge_dimension(new, stored, ["p", "q"], "key", small_rows=small)
        assert sorted((tuple(r) for r in out.select("p", "q", "note", "key").collect()), key=repr) == sorted(want, key=repr)
    assert ops.merge_dimension(new, stored.limit(0), ["p", "q"], "key").agg(F.max("key"), F.min("key")).first() == (4, 0)
    assert ops.merge_dimension(new.limit(0), stored, ["p", "q"], "key").count() == 3
    for a, b in ((new.unionAll(new), stored), (new, stored.unionAll(stored))):
        with pytest.raises(ValueError, match="repeat"):
            ops.merge_dimension(a, b, ["p", "q"], "key")
