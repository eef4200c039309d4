import pytest
from pyspark.sql import functions as F

from panelspark.operators import impute, lookup, quality, rank, reshape


def test_winner_sums_first_and_breaks_ties_by_name(spark, rows):
    votes = [(2000, "01", "B", 5), (2000, "01", "A", 3), (2000, "01", "A", 2), (2000, "02", "B", None), (2000, "02", "C", 1)]
    df = spark.createDataFrame(votes, "y int, u string, c string, v int")
    assert rows(rank.winner(df, ["y", "u"], "c", "v", "total")) == [(2000, "01", "A", 5), (2000, "02", "C", 1)]


def test_top_per_group_limits_below_the_shuffle(spark):
    df = spark.range(1000).withColumn("g", F.col("id") % 2)
    plan = rank.top_per_group(df, ["g"], [F.desc("id")], 2)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("WindowGroupLimit") == 2
    assert sorted(r.id for r in plan.collect()) == [996, 997, 998, 999]


def test_majority_and_distribution(spark, rows):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (2, "c"), (2, "c"), (2, "a")], "y int, l string")
    assert rows(rank.majority(df, "l", ["y"], 2)) == [(1, "a", 1, 2, 50.0), (2, "c", 2, 3, 66.67)]
    assert rows(rank.majority(df, "l"), "l", "n", "n_rows") == [("a", 2, 5)]
    assert rows(rank.distribution(df, "l"), "l", "n", "pct") == [("a", 2, 40.0), ("b", 1, 20.0), ("c", 2, 40.0)]


def test_majority_uses_weights(spark, rows):
    df = spark.createDataFrame([("a", 3), ("b", 2), ("b", 2)], "l string, w bigint")
    assert rows(rank.majority(df, "l", weight="w"), "l", "n", "n_rows") == [("b", 4, 7)]


def test_upsert_is_idempotent(spark, rows):
    base = spark.createDataFrame([(1, 1, "a"), (2, 1, "b")], "k int, v int, x string")
    delta = spark.createDataFrame([(2, 1, "B"), (1, 0, "old"), (3, 1, "c")], "k int, v int, x string")
    once = rank.upsert_latest(base, delta, ["k"], "v", ["x"])
    assert rows(once) == [(1, 1, "a"), (2, 1, "B"), (3, 1, "c")]
    assert rows(rank.upsert_latest(once, delta, ["k"], "v", ["x"])) == rows(once)


def test_map_values_defaults(spark):
    df = spark.createDataFrame([("a",), ("z",), (None,)], "c string")
    table = {"a": "A"}
    got = df.select(
        lookup.map_values("c", table), lookup.map_values("c", table, lookup.KEEP), lookup.map_values("c", table, "?")
    ).collect()
    assert [tuple(r) for r in got] == [("A", "A", "A"), (None, "z", "?"), (None, None, "?")]


def test_lookup_never_multiplies_rows(spark, rows):
    df = spark.createDataFrame([("g",), ("x",)], "o string")
    table = spark.createDataFrame([("g", 2), ("g", 2), ("g", 1)], "k string, id int")
    assert rows(lookup.map_from_table(df, "o", table, "k", "id", "party")) == [("g", 1), ("x", None)]


def test_semi_anti_and_missing_units(spark, rows):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "u string, v int")
    other = spark.createDataFrame([("b",), ("b",), ("c",)], "u string")
    assert rows(lookup.rows_with_match(df, other, ["u"])) == [("b", 2)]
    assert rows(lookup.rows_without_match(df, other, ["u"])) == [("a", 1)]
    full = lookup.add_missing_units(df.withColumn("y", F.lit(2021)), other, "u", {"y": F.lit(2022)})
    assert rows(full, "u", "v", "y") == [("a", 1, 2021), ("b", 2, 2021), ("c", None, 2022)]


def test_unpivot_undoes_pivot(spark, rows):
    df = spark.createDataFrame([("a", "2000", 1.0), ("a", "2001", 2.0), ("b", "2001", 3.0)], "u string, y string, v double")
    wide = reshape.to_wide(df, ["u"], "y", ["2000", "2001"], F.sum("v"))
    back = reshape.to_long(wide, ["u"], ["2000", "2001"], "y", "v")
    assert rows(back.dropna()) == rows(df)


def test_to_long_tolerates_text_cells(spark, rows):
    df = spark.createDataFrame([("01", "AIN", "7")], "c string, `Libellé` string, `X (Y)` string")
    long = reshape.to_long(df, ["c"], ["Libellé", "X (Y)"], "n", "v", "bigint")
    assert rows(long) == [("01", "Libellé", None), ("01", "X (Y)", 7)]


def test_month_columns(spark, rows):
    df = spark.createDataFrame([("1", "2", None, "5", "a"), ("1", "1", "1", None, "b")], "s string, _2000_01 string, _2000_02 string, _2001_01 string, label string")
    assert rows(reshape.month_columns_to_years(df, ["s"])) == [("1", 2000, 4.0), ("1", 2001, 5.0)]
    assert rows(reshape.month_columns_to_years(df, ["s"], years=range(2001, 2002))) == [("1", 2001, 5.0)]


@pytest.mark.parametrize("keep", [False, True])
def test_densify(spark, rows, keep):
    df = spark.createDataFrame([("a", 2000, 5), ("a", 1990, 1), ("b", None, 9)], "u string, y int, n int")
    dense = reshape.densify(df, df, ["u"], "y", 2000, 2001, {"n": 0}, keep_outside=keep)
    want = [("a", 2000, 5), ("a", 2001, 0), ("b", 2000, 0), ("b", 2001, 0)]
    assert rows(dense) == sorted(want + ([("a", 1990, 1)] if keep else []))
    assert "CartesianProduct" not in dense._jdf.queryExecution().executedPlan().toString()


def test_baseline(spark, rows):
    df = spark.createDataFrame([("a", 2001, 5.0), ("a", 2002, 6.0)], "u string, y int, v double")
    assert rows(reshape.add_baseline(df, ["u"], "y", 2000, {"v": 0.0}))[0] == ("a", 2000, 0.0)


def test_ols_fill(spark, rows):
    points = [("a", 2000, None), ("a", 2001, 11.6), ("a", 2002, 13.2), ("a", 2003, 14.8), ("b", 2000, 4.0), ("b", 2001, None), ("c", 2000, None)]
    df = spark.createDataFrame(points, "u string, y int, v double")
    cut = rows(impute.ols_fill(df, ["u"], "y", "v", "trunc"), "u", "y", "v")
    assert cut[0] == ("a", 2000, 10.0)  # predicted 10.0 by the line 11.6, 13.2, 14.8
    assert ("b", 2001, None) in cut and ("c", 2000, None) in cut and ("a", 2001, 11.6) in cut
    some = impute.ols_fill(df, ["u"], "y", "v", "round", 0, only=F.col("u") == "b")
    assert ("a", 2000, None) in rows(some, "u", "y", "v")


def test_ols_fill_truncates_toward_zero(spark, rows):
    values = {2014: 9000, 2015: 9365, 2016: 9731}
    df = spark.createDataFrame([(y, values.get(y)) for y in range(2000, 2017)], "y int, v int").withColumn("u", F.lit("06"))
    filled = dict(rows(impute.ols_fill(df, ["u"], "y", "v"), "y", "v"))
    slope, mean = 365.5, sum(values.values()) / 3
    assert filled[2000] == int(mean + slope * (2000 - 2015))


def test_quality_checks(spark, rows):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, None), (None, None)], "k int, x string")
    assert rows(quality.duplicate_keys(df, ["k"])) == [(1, 2)]
    parent = spark.createDataFrame([(1,)], "id int")
    assert rows(quality.orphan_keys(df, "k", parent, "id")) == [(2, 1)]
    assert rows(quality.missing_values(df, ["k", "x"])) == [("k", 1), ("x", 2)]
    assert quality.without_empty_rows(df).count() == 3
