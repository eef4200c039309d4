import random

import numpy as np
import pandas as pd
import pytest

from panelspark.operators import profile


@pytest.mark.parametrize("seed", range(4))
def test_quantiles_equal_linear_interpolation(spark, seed):
    """Coarse sketches force wide and narrow brackets; the answer stays exact."""
    rng = random.Random(seed)
    n = rng.choice([1, 2, 7, 500, 4001])
    values = [rng.choice([rng.gauss(0, 1), 0.0, float(rng.randint(-3, 3)), rng.expovariate(1e-6)]) for _ in range(n)]
    df = spark.createDataFrame([(v, None if i % 7 == 0 else v) for i, v in enumerate(values)], "a double, b double")
    for accuracy in (50, 10_000):
        got = {r["column"]: r for r in profile.quantiles(df.repartition(3), ["a", "b"], accuracy=accuracy, slices=8).collect()}
        for name, data in (("a", values), ("b", [v for i, v in enumerate(values) if i % 7])):
            if data:
                want = np.percentile(data, [25, 50, 75])
                assert [got[name][c] for c in ("p25", "p50", "p75")] == pytest.approx(list(want), rel=1e-12, abs=1e-12)


def test_describe_matches_pandas(spark):
    pdf = pd.DataFrame({"x": [1.0, 2.0, 2.0, 9.0, None], "y": [5.0] * 5})
    got = {r["column"]: r for r in profile.describe(spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None), "x double, y double"), ["x", "y"]).collect()}
    want = pdf.describe()
    for c in ("x", "y"):
        for ours, theirs in (("n", "count"), ("mean", "mean"), ("std", "std"), ("min", "min"), ("p25", "25%"), ("p50", "50%"), ("p75", "75%"), ("max", "max")):
            assert got[c][ours] == pytest.approx(want[c][theirs], abs=1e-4)


def test_top_values_only_of_small_columns(spark, rows):
    df = spark.createDataFrame([("a", str(i)) for i in range(60)] + [("b", "x"), (None, "y")], "s string, t string")
    assert rows(profile.top_values(df, ["s", "t"])) == [("s", "a", 60, 1), ("s", "b", 1, 2)]
    assert rows(profile.distinct_counts(df, ["s", "t"])) == [("s", 2), ("t", 62)]


def test_outliers(spark, rows):
    df = spark.createDataFrame([(0.0, 1.0)] * 50 + [(100.0, 1.0), (None, 1.0)], "v double, w double")
    (found,) = profile.outliers(df, ["v", "w"]).collect()
    assert (found["column"], found["n_outliers"], found["pct_outliers"]) == ("v", 1, round(100 / 52, 4))
    assert rows(profile.outlier_examples(df, ["v", "w"])) == [("v", 100.0, 1)]


def test_shape_missing_and_correlation(spark, rows):
    df = spark.createDataFrame([(1, 2.0), (2, 4.0), (3, None)], "a int, b double")
    assert rows(profile.shape(df)) == [("a", 0, "int", 3, 3), ("b", 1, "double", 3, 2)]
    assert rows(profile.missing(df)) == [("a", 0, 0.0), ("b", 1, 33.3333)]
    assert rows(profile.correlations(df.dropna(), ["a", "b"])) == [("a", "a", 1.0), ("a", "b", 1.0), ("b", "a", 1.0), ("b", "b", 1.0)]
