import hashlib

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from panelspark.plans.panel import NATION, REGION, Measure, build_panel
from panelspark.operators.numbering import slice_digits, surrogate_id
from panelspark.plans.star import Dimension, analysis_set, build_fact, conform

UNITS = [("01", "84"), ("02", "32"), ("03", "84")]


@pytest.fixture
def units(spark):
    return spark.createDataFrame(UNITS, "unit string, region string")


def unit_df(spark, rows):
    return spark.createDataFrame(rows, "year int, unit string, v int")


def test_panel_equals_full_outer_chain(spark, rows, units):
    a = unit_df(spark, [(2000, "01", 1), (2000, "01", 0), (2001, "02", 2), (1999, "01", 9), (2000, "99", 9)])
    region = spark.createDataFrame([(2000, "84", 7.0)], "year int, region string, v double")
    extra = unit_df(spark, [(2000, "01", 5), (2001, "03", 6)])
    late = unit_df(spark, [(2001, "03", 8)])
    nation = spark.createDataFrame([(2000, 0.5)], "year int, v double")
    measures = [
        Measure("a", a, "v"),
        Measure("r", region, "v", REGION),
        Measure("opt", extra, "v", optional=True),
        Measure("late", late, "v"),
        Measure("n", nation, "v", NATION),
    ]
    want = [
        ("2000_01", 0, 7.0, 5, None, 0.5),
        ("2000_03", None, 7.0, None, None, 0.5),
        ("2001_02", 2, None, None, None, None),
        # Its optional value comes before the measure that brings the key in, so it stays out.
        ("2001_03", None, None, None, 8, None),
    ]
    listed = build_panel(measures, units, 2000, 2001, ["01", "02", "03"])
    assert rows(listed.drop("year", "unit")) == want
    joined = build_panel(measures, units, 2000, 2001)
    assert rows(joined.drop("year", "unit")) == want


def test_conform_matches_names_without_case_and_drops_id(spark):
    target = StructType([StructField("id", IntegerType()), StructField("N_Total", IntegerType()), StructField("unit", StringType())])
    df = spark.createDataFrame([("7", "x", 1, 3)], "n string, UNIT string, id int, other int")
    out = conform(df, {"n": "n_total"}, target)
    assert out.dtypes == [("N_Total", "int"), ("unit", "string")]
    assert conform(spark.createDataFrame([("bad",)], "n string"), {"n": "n_total"}, target).first()[0] is None
    with pytest.raises(ValueError):
        conform(df.select("other"), {}, target)


def test_surrogate_ids_are_dense_ordered_by_year_and_repeatable(spark):
    df = spark.range(500).select((2000 + F.col("id") % 3).cast("int").alias("year"), F.col("id").cast("string").alias("unit"))
    got = {(r.year, r.unit): r.id for r in surrogate_id(df, "year", ["unit"]).collect()}
    assert sorted(got.values()) == list(range(1, 501))
    want = sorted(got, key=lambda k: (k[0], hashlib.md5(k[1].encode()).hexdigest()))
    assert [got[k] for k in want] == list(range(1, 501))
    again = surrogate_id(df.repartition(5), "year", ["unit"])
    assert got == {(r.year, r.unit): r.id for r in again.collect()}
    assert [slice_digits(n) for n in (0, 10**7, 10**8, 15 * 10**10)] == [2, 2, 3, 5]


def test_fact_and_analysis_sets(spark, rows, units):
    label = Dimension("party", spark.createDataFrame([(1, 2000, "01", 6)], "id int, year int, unit string, p int"), attributes={"p": "label"})
    twice = spark.createDataFrame([(2, 2000, "01", 10), (1, 2000, "01", 11), (3, 2001, "02", 12)], "id int, year int, unit string, v int")
    safety = Dimension("safety", twice, attributes={"v": "safety"})
    money = Dimension("money", spark.createDataFrame([(1, 2000, "84", 1.5)], "id int, year int, region string, v double"), REGION, attributes={"v": "money"})
    dims = [label, safety, money]
    fact = build_fact(dims, units, 2000, 2001)
    assert rows(fact) == [("2000_01", 1, 1, 1), ("2000_03", None, None, 1), ("2001_02", None, 3, None)]
    assert rows(analysis_set(fact, dims, label, True)) == [("2000_01", 6, 11, 1.5)]
    assert rows(analysis_set(fact, [label, safety], label, False)) == [("2001_02", None, 12)]


def test_national_dimension_keeps_the_whole_grid(spark, units):
    nation = Dimension("n", spark.createDataFrame([(1, 2000)], "id int, year int"), NATION)
    assert build_fact([nation], units, 2000, 2001).count() == len(UNITS)
