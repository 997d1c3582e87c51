import random

import pytest
from pyspark.sql import functions as F

from portolan import schemas, sinks, sources
from portolan.sinks import staging as staging_module
from portolan.sinks.writers import with_comments


def test_mapping_csv_with_quotes(spark, tmp_path):
    names = {5001: "plain", 5002: "one, two", 5003: '"', 5004: 'a "b", c', 5005: ",", 5006: "(x,y)"}
    path = tmp_path / "mapping.csv"
    quoted = {k: '"' + v.replace('"', '""') + '"' if set(v) & set(',"') else v for k, v in names.items()}
    path.write_text("code,Name\n" + "".join(f"{k},{v}\n" for k, v in quoted.items()))
    for schema in (schemas.MAPPING, None):
        df = sources.read_csv(spark, str(path), schema)
        assert df.dtypes == [("code", "int"), ("Name", "string")]
        assert dict(map(tuple, df.collect())) == names
    # names resolve whatever their case
    assert sources.read_csv(spark, str(path), schemas.MAPPING).select("NAME", "CODE").count() == 6


def test_header_is_checked_against_the_schema(spark, tmp_path):
    path = tmp_path / "swapped.csv"
    path.write_text("Name,code\nX,1\n")
    with pytest.raises(Exception, match="(?i)header"):
        sources.read_csv(spark, str(path), schemas.MAPPING).collect()


def test_semicolon_csv(spark, tmp_path):
    path = tmp_path / "cities.csv"
    header = (
        "City;State;Median Age;Male Population;Female Population;Total Population;Number of Veterans;"
        "Foreign-born;Average Household Size;State Code;Race;Count"
    )
    path.write_text(header + "\nSan José;California;33.1;;2;3;4;5;2.6;CA;White;9\n", encoding="utf-8")
    df = sources.read_csv(spark, str(path), schemas.DEMOGRAPHICS, ";")
    assert tuple(df.first()) == ("San José", "California", 33.1, None, 2, 3, 4, 5, 2.6, "CA", "White", 9)


def test_csv_sample_with_index_column(spark, tmp_path):
    path = tmp_path / "sample.csv"
    path.write_text(",cicid,visatype\n0,77.0,K1\n")
    df = sources.read_csv(spark, str(path))
    assert df.drop("_c0").dtypes == [("cicid", "double"), ("visatype", "string")]


def test_csv_keeps_blanks_quotes_and_separators(spark, tmp_path):
    df = spark.createDataFrame([(1, None), (2, ""), (3, ' x,y;"z" '), (4, "a\\b")], "id int, s string")
    for sep in ",;":
        path = str(tmp_path / f"csv{ord(sep)}")
        sinks.write_csv(df, path, sep)
        assert sorted(map(tuple, sources.read_csv(spark, path, df.schema, sep).collect())) == [
            (1, None),
            (2, ""),
            (3, ' x,y;"z" '),
            (4, "a\\b"),
        ]


LABELS = """a line without any pair ;

  value first
   k1 =  'up, down'
   k2 =  'old'
   k2 =  'new'
   k3 = 'cut=off'

   k4 = 'semi; colon'
   k5='tight' ;
  value $second
   'q' = 'quoted code'
   k1 = 'elsewhere'
;
"""


def catalog(df):
    return {r.code: r.name for r in df.collect()}


def test_label_lines(spark, tmp_path):
    path = tmp_path / "labels.sas"
    path.write_text(LABELS)
    first = {"k1": "up, down", "k2": "new", "k3": "cut", "k4": "semi; colon", "k5": "tight"}
    second = {"'q'": "quoted code", "k1": "elsewhere"}
    assert catalog(sources.read_label_catalog(spark, str(path), section="first")) == first
    assert catalog(sources.read_label_catalog(spark, str(path))) == first | second
    assert catalog(sources.read_label_catalog(spark, str(path), section="second")) == second
    assert catalog(sources.read_label_catalog(spark, str(path), section="absent")) == {}
    # the section is found when the file is cut into many splits, and runs to
    # the end of the file if nothing closes it
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        assert catalog(sources.read_label_catalog(spark, str(path), section="first")) == first
        path.write_text(LABELS.replace("\n;\n", "\n"))
        assert catalog(sources.read_label_catalog(spark, str(path), section="second")) == second
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_label_order_holds_over_splits_and_files(spark, tmp_path):
    """Codes repeat over several files, each cut into many splits; the last line wins."""
    folder = tmp_path / "labels"
    folder.mkdir()
    want = {}
    for f in range(3):
        lines = []
        for i in range(400):
            code = str((i * 7 + f) % 90)
            want[code] = f"NAME {f} {i}"
            lines.append(f"   {code} =  '{want[code]}'")
        (folder / f"part-{f}.txt").write_text("\n".join(lines) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1500")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        df = sources.read_label_catalog(spark, str(folder))
        assert spark.read.text(str(folder)).rdd.getNumPartitions() > 10
        assert catalog(df) == want
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_file_inventory(spark, tmp_path):
    (tmp_path / "a b.sas").write_bytes(b"x" * 10)
    (tmp_path / "c.sas").write_bytes(b"y")
    df = sources.file_inventory(spark, str(tmp_path))
    assert sorted(map(tuple, df.collect())) == [("a b.sas", 10), ("c.sas", 1)]


def test_partitioned_parquet(spark, tmp_path):
    df = spark.range(1000).selectExpr("id", "id % 3 AS y", "id % 2 AS m")
    for small in (True, False):
        path = tmp_path / f"p{small}"
        sinks.write_parquet(df, str(path), ["y", "m"], small_folders=small)
        assert len(list(path.glob("y=*/m=*"))) == 6
        assert len(list(path.glob("y=*/m=*/*.parquet"))) == 6
        back = sources.load_table(spark, str(path))
        assert sorted(back.select("id", "y", "m").collect()) == sorted(df.collect())
        plan = back.where("y = 1")._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(y" in plan
        # overwriting replaces every folder
        sinks.write_parquet(df.where("y = 0"), str(path), ["y", "m"], small_folders=small)
        assert {p.name for p in path.glob("y=*")} == {"y=0"}


def test_comments_survive_parquet(spark, tmp_path):
    df = with_comments(spark.range(1), {"id": "a number", "absent": "ignored"})
    sinks.write_parquet(df, str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).schema["id"].metadata["comment"] == "a number"


def test_staging_uses_the_configured_folder_and_can_be_cleared(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    staging = sinks.Staging(spark)
    assert staging.folder.startswith(root)
    df = staging.write(spark.range(5).withColumn("a b", F.lit("x")), "t")
    assert df.count() == 5 and df.columns == ["id", "a b"]
    assert staging.path("t") != staging.path("t")
    staging.clear()
    with pytest.raises(Exception):
        df.collect()


def test_staging_refuses_a_machine_local_folder_on_a_cluster():
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master, applicationId = "yarn", "app-1"

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        staging_module.staging_root(Session())
    Context.master = "local-cluster[2,1,1024]"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        staging_module.staging_root(Session())
    Context.master = "local[2]"
    assert staging_module.staging_root(Session()) == staging_module.staging_root(Session())


def test_unfit_csv_values_fail_or_are_set_aside(spark, tmp_path):
    path = tmp_path / "cities.csv"
    path.write_text("code;men\n1;12.0\n2;1,234\n3;12\n4;\nx;\"y\"\n")
    schema = "code int, men int"
    with pytest.raises(Exception, match="(?i)malformed"):
        sources.read_csv(spark, str(path), schema, ";").collect()
    good, bad = sources.read_csv_with_rejects(spark, str(path), schema, ";")
    assert sorted(map(tuple, good.collect())) == [(3, 12), (4, None)]
    assert sorted((r.line, r.bad_columns) for r in bad.collect()) == [
        ("1;12.0", ["men"]), ("2;1,234", ["men"]), ('x;"y"', ["code", "men"]),
    ]


def test_line_breaks_within_values(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a\nb "c", d;'), (2, "e\n")], "id int, s string")
    path = str(tmp_path / "csv")
    sinks.write_csv(df, path)
    assert sorted(map(tuple, sources.read_csv(spark, path, df.schema, multiline=True).collect())) == [
        (1, 'a\nb "c", d;'), (2, "e\n"),
    ]


def test_indexed_csv_has_its_header_checked(spark, tmp_path):
    path = tmp_path / "sample.csv"
    path.write_text(",k,v\n0,1.5,x\n")
    assert [tuple(r) for r in sources.read_indexed_csv(spark, str(path), "k double, v string").collect()] == [(1.5, "x")]
    with pytest.raises(ValueError, match="header"):
        sources.read_indexed_csv(spark, str(path), "v string, k double")


def test_bad_values_fail_whatever_is_read(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text("a,b,c\n1,2,x\n3,oops,y\n")
    short = tmp_path / "short.csv"
    short.write_text("a,b,c\n1,2,x\n3,4\n")
    for file in (path, short):
        df = sources.read_csv(spark, str(file), "a int, b int, c string")
        for query in (df, df.select("a"), df.where("a = 1").select("c"), df.agg(F.count("*")), df.limit(5)):
            with pytest.raises(Exception, match="(?i)malformed"):
                query.collect()
    good = tmp_path / "good.csv"
    good.write_text("a,b,c\n1,2,x\n,,\n")
    df = sources.read_csv(spark, str(good), "a int, b int, c string")
    assert df.count() == 2 and [tuple(r) for r in df.where("a = 1").select("c").collect()] == [("x",)]


@pytest.fixture
def small_ranges(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")
    yield lambda n: [spark.conf.set(k, v) for k, v in zip(names, (str(n), "0", "1"))]
    for k in names:
        spark.conf.unset(k)


def test_records_are_found_at_every_cut(spark, tmp_path, small_ranges):
    """Files cut at many places, within quotes, line breaks, separators and doubled quotes too."""
    rng = random.Random(4)
    folder = tmp_path / "csv"
    folder.mkdir()
    parts = ["a", "\n", '"', ",", "\r\n", "é", " ", "\n\n", '""', "bc", '\n"\n']
    want = []
    for f in range(3):
        lines = ["k,s,t"]
        for i in range(60):
            s, t = ("".join(rng.choice(parts) for _ in range(rng.randint(0, 9))) for _ in range(2))
            want.append((f * 1000 + i, s or None, t))
            lines.append(",".join([str(f * 1000 + i), f'"{s.replace(chr(34), chr(34) * 2)}"' if s else "", '"' + t.replace('"', '""') + '"']))
        end = "\r\n" if f == 1 else "\n"
        (folder / f"part-{f}.csv").write_bytes((end.join(lines) + end).encode())
    schema = "k int, s string, t string"
    for n in (60, 10**6):
        small_ranges(n)
        df = sources.read_csv(spark, str(folder), schema, multiline=True)
        assert sorted(map(tuple, df.collect()), key=lambda r: r[0]) == want, n
    small_ranges(10**6)
    # the reader that gives a file to one task; it rewrites line ends within values if records end in \r\n
    one = spark.read.options(header=True, multiLine=True, escape='"', nullValue="\u0000", emptyValue="").schema(schema).csv(str(folder))
    same = [r for r in want if r[0] // 1000 != 1]
    assert sorted((tuple(r) for r in one.collect() if r.k // 1000 != 1), key=lambda r: r[0]) == same


def test_records_that_go_over_several_ranges(spark, tmp_path, small_ranges):
    long = "line\n" * 200 + 'with "quotes"\n'
    path = tmp_path / "long.csv"
    path.write_text("k,s\n1,short\n2,\"" + long.replace('"', '""') + "\"\n3,\"" + "x\n" * 50 + "\"\n\n4,end")
    small_ranges(100)
    df = sources.read_csv(spark, str(path), "k int, s string", multiline=True)
    assert sorted(map(tuple, df.collect())) == [(1, "short"), (2, long), (3, "x\n" * 50), (4, "end")]


def test_multiline_files_that_do_not_fit(spark, tmp_path):
    def file(name, text):
        (tmp_path / name).write_text(text)
        return str(tmp_path / name)

    schema = "k int, s string"
    for name, text, match in [
        ("header", "s,k\n1,a\n", "header"), ("wide", "k,s,t\n1,a,b\n", "header"), ("inner", 'k,s\n1,a"b"\n', "quote"),
        ("open", 'k,s\n1,"a\n2,b\n', "quote"), ("value", "k,s\nx,a\n", "(?i)malformed"), ("short", "k,s\n1\n", "(?i)malformed"),
    ]:
        for query in (lambda df: df.collect(), lambda df: df.count()):
            with pytest.raises(Exception, match=match):
                query(sources.read_csv(spark, file(name, text), schema, multiline=True))
    good, bad = sources.read_csv_with_rejects(spark, file("some", 'k,s\n1,"a\nb"\nx,"c\nd"\n2\n'), schema, multiline=True)
    assert [tuple(r) for r in good.collect()] == [(1, "a\nb")]
    assert sorted((r.line, r.bad_columns) for r in bad.collect()) == [("2", []), ('x,"c\nd"', ["k"])]
    assert sources.read_csv(spark, file("none", "k,s\n"), schema, multiline=True).count() == 0


def test_one_large_file_is_parsed_by_many_tasks(spark, tmp_path, small_ranges):
    """As many byte ranges as the size allows, none of which reads another's lines."""
    path = tmp_path / "large.csv"
    with open(path, "w") as out:
        out.write("k,s\n")
        for i in range(20_000):
            out.write(f'{i},"line {i}\nand ""more""\n"\n')
    small_ranges(50_000)
    staging = sinks.Staging(spark)
    df = sources.read_csv(spark, str(path), "k int, s string", multiline=True, staging=staging)
    assert df.agg(F.count("*"), F.sum("k"), F.min(F.length("s"))).first() == (20_000, 199990000, 18)
    lines = spark.read.parquet(staging.folder + "/csv-lines-*")
    ranges = lines.groupBy("start").count().collect()
    assert len(ranges) == -(-path.stat().st_size // 50_000) and max(r["count"] for r in ranges) < 5000
    staging.clear()
