import math
import os
import subprocess
import sys
from dataclasses import replace
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelspark.ml import evaluate, knn, models, noise, pipeline, predict, scale, split, vote

REPO = Path(__file__).resolve().parent.parent


def test_split_is_exact_disjoint_and_complete(spark):
    df = spark.range(1000).withColumn("label", F.when(F.col("id") % 10 == 0, F.lit("rare")).when(F.col("id") % 3 > 0, F.lit("often")))
    parts = split.split(df, "id", ["label"], 80).collect()
    assert sorted(r.id for r in parts) == list(range(1000))
    for label in ("rare", "often", None):
        mine = [r for r in parts if r.label == label]
        assert sum(r.part == "train" for r in mine) == math.ceil(len(mine) * 0.8)
    again = {r.id: r.part for r in split.split(df.repartition(7), "id", ["label"], 80).collect()}
    assert again == {r.id: r.part for r in parts}


def test_sample_and_folds(spark):
    df = spark.range(101).withColumn("label", F.lit(1))
    assert split.sample(df, "id", 50).count() == 51
    sizes = sorted(r["count"] for r in split.folds(df, "id", "label", 4).groupBy("fold").count().collect())
    assert sizes == [25, 25, 25, 26]
    assert [split.fold_count(n) for n in (1, 2, 3, 9)] == [2, 2, 3, 5]


def test_rare_classes_leave(spark, rows):
    df = spark.createDataFrame([("a",)] * 2 + [("b",)] * 3, "label string")
    assert rows(split.without_rare_classes(df, "label")) == [("b",)] * 3


def test_scaling_of_a_constant_column(spark, rows):
    train = spark.createDataFrame([(1.0, 7.0), (3.0, 7.0)], "a double, b double")
    assert rows(scale.fit_standard(train, ["a", "b"]).apply(train)) == [(-1.0, 0.0), (1.0, 0.0)]
    assert rows(scale.fit_minmax(train, ["a", "b"]).apply(train)) == [(0.0, 0.0), (1.0, 0.0)]


def test_noise_has_the_right_size_and_ignores_partitions(spark):
    df = spark.range(20_000).withColumn("x", (F.col("id") % 100).cast("double"))
    noisy = noise.add_noise(df, "id", ["x"], 0.3, 1)
    gap = [r.d for r in noisy.join(df.withColumnRenamed("x", "y"), "id").select((F.col("x") - F.col("y")).alias("d")).collect()]
    spread = df.agg(F.stddev_samp("x")).first()[0]
    assert abs(np.mean(gap)) < 0.02 * spread and np.std(gap) == pytest.approx(0.3 * spread, rel=0.03)
    again = noise.add_noise(df.repartition(5), "id", ["x"], 0.3, 1)
    # The deviation is merged from partial moments, so its last bits may differ.
    rounded = [d.select("id", F.round("x", 6)) for d in (noisy, again)]
    assert rounded[0].exceptAll(rounded[1]).count() == 0


@pytest.mark.parametrize("metric", ["manhattan", "euclidean"])
def test_neighbours_equal_brute_force_over_many_cells_and_blocks(spark, monkeypatch, metric):
    """Tiny blocks force pivots, pruning, sub-blocks and chunks; a third of the rows are copies."""
    monkeypatch.setattr(knn, "BLOCK_ROWS", 16)
    rng = np.random.default_rng(3)
    points = np.round(rng.normal(size=(240, 3)) + rng.integers(0, 4, size=(240, 1)) * 5, 2)
    points[::3] = points[0]
    asked = np.round(rng.normal(size=(60, 3)) + rng.integers(0, 4, size=(60, 1)) * 5, 2)
    asked[0] = points[0]
    frame = lambda a, off: spark.createDataFrame([(i + off, int(i % 4), [float(x) for x in v]) for i, v in enumerate(a)], "id bigint, label int, v array<double>")
    pairs = spark.sparkContext.accumulator(0)
    got = knn.neighbours(frame(points, 0), frame(asked, 1000), "id", "v", "label", 3, metric, pairs).collect()
    assert 0 < pairs.value < 0.7 * len(points) * len(asked)
    gap = asked[:, None, :] - points[None, :, :]
    d = np.abs(gap).sum(axis=2) if metric == "manhattan" else np.sqrt((gap * gap).sum(axis=2))
    want = {(1000 + i, int(j), p + 1) for i in range(60) for p, j in enumerate(np.argsort(d[i], kind="stable")[:3])}
    assert {(r.id, r.neighbour, r.position) for r in got} == want


def test_knn_votes(spark, rows):
    train = spark.createDataFrame([(1, 2, [0.0]), (2, 1, [1.0]), (3, 1, [1.2])], "id int, label int, v array<double>")
    asked = spark.createDataFrame([(9, [0.0]), (8, [0.4])], "id int, v array<double>")
    assert rows(knn.predict(train, asked, "id", "v", "label", 2)) == [(8, 1), (9, 1)]  # ties: smallest label
    assert rows(knn.predict(train, asked, "id", "v", "label", 2, weights="distance")) == [(8, 2), (9, 2)]
    assert rows(knn.predict(train, asked, "id", "v", "label", 10)) == [(8, 1), (9, 1)]


def test_vote_and_scores(spark, rows):
    p = [spark.createDataFrame(list(enumerate(v)), "id int, prediction int") for v in ([1, 2], [2, 2], [3, 1])]
    assert rows(vote.hard_vote(p, "id")) == [(0, 1), (1, 2)]
    df = spark.createDataFrame([(1, 1), (1, 2), (2, 2), (3, 2)], "label int, prediction int")
    report = {r["name"]: r for r in evaluate.class_report(df).collect()}
    assert tuple(report["1"])[1:] == (1.0, 0.5, 0.666667, 2)
    assert tuple(report["3"])[1:] == (0.0, 0.0, 0.0, 1)
    assert report["accuracy"]["f1"] == 0.5 and report["macro avg"]["recall"] == 0.5
    assert report["weighted avg"]["precision"] == pytest.approx((2 * 1 + 1 / 3) / 4, abs=1e-6)
    assert rows(evaluate.confusion(df)) == [(1, 1, 1), (1, 2, 1), (2, 2, 1), (3, 2, 1)]


def test_best_model_takes_the_first_on_ties(spark):
    df = spark.createDataFrame([("a", 2, 0.5), ("b", 1, 0.5), ("c", 3, 0.1)], "m string, position int, accuracy double")
    assert evaluate.best_model(df).first()["m"] == "b"


def test_chosen_years(spark, rows):
    df = spark.createDataFrame([("2000_01",), ("2001_01",), ("broken",)], "k string")
    valid, known = range(2000, 2023), {2002}
    assert rows(predict.keep_chosen_years(df, "k", [2001], valid, known)) == [("2001_01",)]
    assert rows(predict.keep_chosen_years(df, "k", [2005], valid, known)) == []
    for wrong in (2002, 1999):
        with pytest.raises(ValueError):
            predict.keep_chosen_years(df, "k", [wrong], valid, known)


def test_yearly_parameters():
    assert models.yearly_parameters("KNN", 2001) == {"k": 3, "metric": "euclidean", "weights": "distance"}
    assert models.yearly_parameters("Random Forest", 2003) == {"trees": 7, "depth": 4, "leaf": 8}
    assert models.yearly_parameters("Decision Tree", 2000) == {"depth": 1, "leaf": 8, "impurity": "gini"}
    assert models.yearly_parameters("no such model", 2001) == {"depth": 2, "leaf": 1, "impurity": "gini"}


@pytest.fixture(scope="module")
def data(spark):
    """Three separable classes and one of two rows, which is dropped."""
    rows = [(f"{2000 + i % 3}_{i:03d}", [2, 4, 7][i % 3], float(i % 3 * 10 + i % 7 * 0.1), float(i % 5)) for i in range(90)]
    rows += [("2000_900", 1, 0.0, 0.0), ("2000_901", 1, 0.0, 0.0)]
    df = spark.createDataFrame(rows, "k string, p int, a double, b double")
    return df, pipeline.prepare(df, "k", "p", ["a", "b"])


def test_prepare(data):
    _, prepared = data
    assert list(prepared.rows.classes) == [2, 4, 7] and prepared.folds == 5 and prepared.rows.n == 72
    assert prepared.part("test", "standard").count() == 18


def test_every_model_trains_and_predicts_known_classes(data):
    _, prepared = data
    for name, params in models.DEFAULTS.items():
        scaling = models.scaling_of(name)
        predictor = models.fit(name, params, prepared.part("train", scaling), prepared.rows, 42)
        scored = predictor(prepared.part("test", scaling))
        assert scored.count() == 18
        assert {r.prediction for r in scored.select("prediction").collect()} <= {2, 4, 7}


def test_comparison_and_yearly_results(spark, data):
    df, prepared = data
    compared = pipeline.compare_models(prepared, ["Decision Tree", "KNN"])
    assert compared.best == "KNN"
    best = {r.model_name: r for r in compared.results.collect()}["KNN"]
    assert best.accuracy == 1.0 and best.cv_mean == 1.0 and best.cv_std == 0.0 and best.winner_name == "Gauche"
    unlabelled = spark.createDataFrame([("2003_01", 20.0, 1.0), ("2003_02", 20.1, 2.0), ("2004_01", 0.0, 1.0)], "k string, a double, b double")
    predicted = pipeline.predict_years(compared, prepared, unlabelled, "k", [2003], range(2000, 2023), {2002})
    assert {(r.key, r.prediction, r.year) for r in predicted.collect()} == {("2003_01", 7, 2003), ("2003_02", 7, 2003)}
    yearly = pipeline.yearly_models(df, "k", "p", ["a", "b"], "Decision Tree", [2003])
    (row,) = pipeline.yearly_results(predicted, yearly, models.PARTY_LABELS, pipeline.dt.datetime(2024, 1, 1)).collect()
    assert (row.winner_id, row.winner_name, row.winner_pct) == (7, "Extrême Droite", 100.0)
    assert row.description.endswith("pour l'année 2003")


def test_too_few_rows(spark):
    df = spark.createDataFrame([(str(i), 1, 0.0) for i in range(9)], "k string, p int, a double")
    with pytest.raises(ValueError):
        pipeline.prepare(df, "k", "p", ["a"])


def test_rows_that_cannot_be_used_are_left_out_and_counted(spark):
    rows = [(f"k{i:03d}", i % 2, str(i % 2 * 10 + i % 5)) for i in range(40)]
    rows += [("x1", None, "1"), ("x2", None, "2"), ("x3", None, "3"), ("y1", 1, None), ("y2", 0, "no number"), ("y3", 0, "NaN")]
    prepared = pipeline.prepare(spark.createDataFrame(rows, "k string, p int, a string"), "k", "p", ["a"])
    assert list(prepared.rows.classes) == [0, 1] and prepared.unusable == 3
    assert prepared.frame.count() == 40
    compared = pipeline.compare_models(prepared, ["KNN"])
    unlabelled = spark.createDataFrame([("2003_01", "10"), ("2003_02", None)], "k string, a string")
    predicted = pipeline.predict_years(compared, prepared, unlabelled, "k", [2003], range(2000, 2023), set())
    assert [(r.key, r.prediction) for r in predicted.collect()] == [("2003_01", 1)]


def test_no_scores_without_folds(data):
    _, prepared = data
    without = replace(prepared, no_folds="classes with fewer than 2 training rows: [2]")
    (row,) = pipeline.compare_models(without, ["Decision Tree"]).results.collect()
    assert (row.cv_mean, row.cv_std) == (None, None) and row.note.endswith("[2]") and row.accuracy > 0


def test_errors_are_not_hidden(data):
    _, prepared = data
    with pytest.raises(KeyError):
        pipeline.cross_validate("KNN", {"weights": "uniform"}, prepared, 1)


def test_workers_need_no_installed_package(tmp_path):
    """A session that is started from another folder, with nothing but the driver's own path set."""
    script = tmp_path / "run.py"
    script.write_text(
        f"import sys; sys.path.insert(0, {str(REPO)!r})\n"
        "from tests.session import local_session\nfrom panelspark.ml import knn\n"
        "spark = local_session('2', 2)\n"
        "df = spark.createDataFrame([(i, i % 2, [float(i)]) for i in range(9)], 'id long, label int, v array<double>')\n"
        "print('PREDICTED', knn.predict(df, df, 'id', 'v', 'label', 1).count())\n"
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "PREDICTED 9" in done.stdout, done.stderr[-2000:]


def test_strong_parameters_train(spark, data):
    """The stronger models on a plain split, with several hidden layers; fewer iterations keep the test short."""
    df, _ = data
    prepared = pipeline.prepare(df, "k", "p", ["a", "b"], train_percent=70, stratified=False)
    assert prepared.part("train", "standard").count() == 63
    perceptron = models.STRONG["MLP (Neural Net)"] | {"iterations": 5}
    compared = pipeline.compare_models(prepared, ["MLP (Neural Net)"], parameters={"MLP (Neural Net)": perceptron})
    (row,) = compared.results.collect()
    assert 0 <= row.accuracy <= 1 and row.winner_id in (2, 4, 7)


@pytest.mark.parametrize("metric", ["manhattan", "euclidean"])
def test_a_task_holds_no_matrix_of_a_whole_block_and_finds_the_same(metric):
    """Single precision only leaves pairs out: ties, close and far points, columns of one value, and values that it cannot hold."""
    import tracemalloc

    rng = np.random.default_rng(5)
    grid = rng.integers(0, 3, (300, 3)).astype(float)
    cases = [(rng.normal(size=(n, d)) * size + shift, rng.normal(size=(m, d)) * size + shift)
             for n, m, d, size, shift in ((90, 700, 64, 0.1, 0.0), (90, 700, 20, 1e-7, 1e3), (50, 60, 3, 1e200, 0.0), (9, 2, 2, 1.0, 0.0))]
    for a, b in [*cases, (grid[:100], grid[100:]), (np.ones((20, 2)), np.ones((30, 2)))]:
        gap = a[:, None, :] - b[None, :, :]
        with np.errstate(over="ignore"):
            d = np.abs(gap).sum(axis=2) if metric == "manhattan" else np.sqrt((gap * gap).sum(axis=2))
            for k in (1, 3):
                best = np.argsort(d, axis=1, kind="stable")[:, :k]
                found = np.take_along_axis(d, best, axis=1)
                for limit in (np.full(len(a), np.inf), found[:, -1]):
                    i, j, distance = knn._nearest(a, b, k, metric, limit)
                    assert i.tolist() == np.repeat(np.arange(len(a)), best.shape[1]).tolist()
                    assert j.tolist() == best.ravel().tolist() and distance.tolist() == found.ravel().tolist()
    a, b = rng.normal(size=(8192, 4)), rng.normal(size=(4096, 4))
    tracemalloc.start()
    knn._nearest(a, b, 2, metric, np.full(len(a), np.inf))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # The matrix of distances alone would be 268 MB.
    assert peak < 20e6
