from pyspark.sql import functions as F

from panelspark.functions import numbers, text


def one(spark, values, expression, kind="string"):
    df = spark.createDataFrame([(v,) for v in values], f"c {kind}")
    return [r[0] for r in df.select(expression).collect()]


def test_name_key_folds_accents_blanks_and_marks(spark):
    got = one(spark, [" Côte-d'Or ", "COTE D OR", None], text.name_key("c"))
    assert got == ["cotedor", "cotedor", None]


def test_unit_code_pads_but_never_truncates(spark):
    got = one(spark, ["1", "01", "2A", "971", '"75"', "7.0", " ", None], text.unit_code("c"))
    assert got[:6] == ["01", "01", "2A", "971", "75", "07"]
    kept = one(spark, got[:6] + ["x", "1234", "00 "], text.is_unit_code("c"))
    assert kept == [True] * 6 + [False] * 3


def test_code_in_range(spark):
    assert one(spark, ["1", "95", "96", "2A", "007"], text.code_in_range("c", 1, 95)) == [True, True, False, False, True]


def test_standard_text_default(spark):
    assert one(spark, ["  PUBLIC ", None], text.standard_text("c")) == ["public", "non spécifié"]


def test_apostrophes_and_brackets(spark):
    got = one(spark, ["GISCARD D’ESTAING (RI)"], text.without_brackets(text.plain_apostrophes("c")))
    assert got == ["GISCARD D'ESTAING"]


def test_panel_key_round_trip(spark):
    assert one(spark, ["2002_01", "x_01", "2002", None], text.panel_key_year("c")) == [2002, None, None, None]
    df = spark.createDataFrame([(2002, "01"), (None, "02")], "y int, u string")
    assert [r[0] for r in df.select(text.panel_key("y", "u")).collect()] == ["2002_01", None]


def test_year_in_path(spark):
    assert one(spark, ["/a/cdsp_presi1974t2.csv", "/a/b.csv"], text.year_in_path("c", r"presi(\d{4})")) == [1974, None]


def test_numbers(spark):
    df = spark.createDataFrame([(1.0, 3.0, 4), (0.0, None, 0)], "a double, b double, n int")
    got = df.select(
        numbers.percent_of("a", "n").alias("p"),
        numbers.mean_of_two("a", "b").alias("m"),
        numbers.deflate(F.lit(14452.0), F.lit(1.97)).alias("d"),
        numbers.flag(F.col("b") == 3.0).alias("f"),
    ).collect()
    assert [tuple(r) for r in got] == [(25.0, 2.0, 14172.8, 1), (0.0, None, 14172.8, 0)]


def test_truncate_and_year_of_text(spark):
    assert one(spark, [3081.9, -2.7, None], numbers.truncate("c"), "double") == [3081, -2, None]
    assert one(spark, ["2004-08-31", "soon", None], numbers.year_of_text("c")) == [2004, None, None]
