import gzip

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from panelspark.sinks import writers
from panelspark.sources import delimited
from panelspark.sources.jdbc import jdbc_options


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_sniffing(spark, tmp_path):
    semicolons = write(tmp_path / "a.csv", "a;b\n1,5;2\n")
    commas = write(tmp_path / "b.csv", "a,b\n1,2\n")
    single = write(tmp_path / "c.csv", "a\n1\n")
    assert [delimited.sniff_separator(spark, p) for p in (semicolons, commas, single)] == [";", ",", ","]
    assert delimited.read_any(spark, semicolons).first().asDict() == {"a": "1,5", "b": "2"}
    assert delimited.read_any(spark, commas, rows=0).count() == 0


def test_schema_makes_bad_fields_null(spark, tmp_path):
    path = write(tmp_path / "a.csv", "an;v\n2000;1.5\nx;\n")
    got = delimited.read_delimited(spark, path, "an int, v double").collect()
    assert [tuple(r) for r in got] == [(2000, 1.5), (None, None)]


def test_tagged_union_skips_absent_files(spark, tmp_path, rows):
    one = write(tmp_path / "PIB été+1.csv", "y;v\n2000;1\n")
    df = delimited.read_tagged(spark, [one, str(tmp_path / "gone.csv")], "y int, v int")
    name = F.regexp_extract("source_file", "([^/]+)$", 1)
    assert rows(df.select("y", name)) == [(2000, "PIB été+1.csv")]
    with pytest.raises(FileNotFoundError):
        delimited.read_tagged(spark, [str(tmp_path / "gone.csv")])


def test_read_each_keeps_codes_as_text(spark, tmp_path):
    write(tmp_path / "presi1965.csv", "Code,X (A)\n01,5\n")
    write(tmp_path / "presi1974.csv", "Code,Y (B)\n2A,6\n")
    frames = delimited.read_each(spark, str(tmp_path / "presi*.csv"))
    assert [df.first()["Code"] for df in frames] == ["01", "2A"]


def test_files_of_one_header_share_a_scan(spark, tmp_path, rows):
    layouts = ["Code;é (A)", "é (A);Code", "Code;é (A);Z"]
    want = set()
    for i in range(30):
        code = f"{i:02d}"
        fields = [[code, "a"], ["a", code], [code, "a", "z"]][i % 3]
        write(tmp_path / f"x{i:02d}+é.csv", ("\ufeff" if i == 4 else "") + layouts[i % 3] + ("\r\n" if i == 7 else "\n") + ";".join(fields) + "\n")
        want.add((code, "a", "z" if i % 3 == 2 else None, f"x{i:02d}+é.csv"))
    write(tmp_path / "x90.csv", "")
    write(tmp_path / "x91.csv", layouts[0] + "\n")
    with gzip.open(tmp_path / "x92.csv.gz", "wt", encoding="utf-8") as out:
        out.write(layouts[1] + "\na;92\n")
    want.add(("92", "a", None, "x92.csv.gz"))
    (tmp_path / "_SUCCESS").write_text("")
    frames = delimited.read_by_header(spark, str(tmp_path / "*"), sep=";")
    assert [sorted(df.columns[:-1]) for df in frames] == [["Code", "é (A)"], ["Code", "é (A)"], ["Code", "Z", "é (A)"]]
    df = delimited.stack(frames)
    got = df.select("Code", "é (A)", "Z", F.regexp_extract("source_file", "([^/]+)$", 1).alias("file")).collect()
    assert {tuple(r) for r in got} == want and len(got) == len(want)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 3
    with pytest.raises(FileNotFoundError):
        delimited.read_by_header(spark, str(tmp_path / "gone*"))


def test_headerless_drops_repeated_headers(spark, tmp_path, rows):
    path = write(tmp_path / "p.csv", "code;n\n01;5\ncode;n\n2A;6\n")
    df = delimited.read_headerless(spark, path, ["c", "n"], F.col("c").rlike("^(2A|[0-9]+)$"))
    assert rows(df) == [("01", "5"), ("2A", "6")]


def test_safe_names(spark):
    df = spark.createDataFrame([(1, 2)], "` Nom du parti` int, `Parc installé éolien (MW)` int")
    assert delimited.sanitise_columns(df).columns == ["Nom_du_parti", "Parc_installé_éolien_MW"]


def test_stack_fills_missing_columns(spark, rows):
    a = spark.createDataFrame([(1, 2)], "x int, y int")
    b = spark.createDataFrame([(3,)], "x int")
    assert rows(delimited.stack([a, b])) == [(1, 2), (3, None)]


def test_jdbc_options():
    options = jdbc_options("jdbc:x", "SELECT 1", "id", (0, 9), 3, properties={"user": "u"})
    assert options["dbtable"] == "(SELECT 1) AS source" and options["numPartitions"] == "3" and options["user"] == "u"
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", "SELECT 1", "id")


SCHEMA = StructType([StructField("id", IntegerType()), StructField("unit", StringType()), StructField("n", IntegerType())])


def test_dimension_tables(spark, tmp_path, rows):
    good = writers.write_csv(spark.createDataFrame([("01", 5)], "Code string, n int"), str(tmp_path / "a_processed.csv"))
    folder = str(tmp_path / "star")
    paths = writers.load_dimensions(spark, {"a": good}, {"a": SCHEMA}, {"a": {"Code": "unit"}}, folder)
    writers.load_dimensions(spark, {"a": good}, {"a": SCHEMA}, {"a": {"Code": "unit"}}, folder)
    assert rows(spark.read.parquet(paths["a"])) == [("01", 5), ("01", 5)]
    # One bad file: nothing of the load is stored, and a repeat doubles nothing.
    files = {"a": good, "b": str(tmp_path / "gone")}
    for _ in range(2):
        with pytest.raises(AnalysisException):
            writers.load_dimensions(spark, files, {"a": SCHEMA, "b": SCHEMA}, {"a": {"Code": "unit"}}, folder)
    assert spark.read.parquet(paths["a"]).count() == 2


def test_processed_path():
    assert writers.processed_path("out/", "raw/x.csv") == "out/x_processed.csv"


def test_create_table_keeps_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    writers.create_table(spark, path, SCHEMA)
    writers.append_table(spark.createDataFrame([("01", 5)], "unit string, n int"), path, SCHEMA)
    writers.create_table(spark, path, SCHEMA)
    assert spark.read.schema(SCHEMA).parquet(path).count() == 1
