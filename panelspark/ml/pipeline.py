"""Train, compare and apply the classifiers.

Rows are split, scaled and settled once; every fit then reads the same small table.  Fits run
side by side from a few driver threads, each one a set of Spark jobs.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from statistics import fmean, pstdev

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.functions.text import panel_key_year
from panelspark.ml import evaluate, forest, models, scale, split
from panelspark.ml.noise import add_noise
from panelspark.ml.predict import keep_chosen_years
from panelspark.operators.lookup import map_values
from panelspark.operators.rank import majority
from panelspark.tables import settle

RESULTS = """position bigint, run_timestamp timestamp, model_name string, description string, accuracy double,
cv_mean double, cv_std double, winner_id bigint, winner_name string, winner_pct double, note string"""
THREADS = 8
MIN_ROWS = 10


@dataclass(frozen=True)
class Prepared:
    """A settled training set: (key, label, idx, part, fold, standard, minmax).

    ``unusable`` counts the rows left out because a feature is no number; ``no_folds`` tells why there can be no
    cross-validation, if so.
    """

    frame: DataFrame
    rows: models.Rows
    folds: int
    std: scale.Scaler
    minmax: scale.Scaler
    features: Sequence[str]
    unusable: int = 0
    no_folds: str | None = None

    def part(self, name: str, scaling: str) -> DataFrame:
        rows = self.frame.filter(F.col("part") == name).withColumn("v", F.col(scaling))
        return rows.select("key", "label", "idx", "fold", "v", array_to_vector("v").alias("x"))

    def ready(self, df: DataFrame, key: str, scaling: str) -> DataFrame:
        """New rows, scaled like the training rows; rows without a number in each feature cannot be scored and are left out."""
        scaler = self.std if scaling == "standard" else self.minmax
        scaled = scaler.apply(df.withColumns({c: F.col(c).try_cast("double") for c in self.features}).dropna(subset=list(self.features)))
        return scaled.select(F.col(key).alias("key"), F.array(*self.features).alias("v")).withColumn(
            "x", array_to_vector("v")
        )


def prepare(
    df: DataFrame,
    key: str,
    label: str,
    features: Sequence[str],
    seed: int = 42,
    noise_level: float = 0.0,
    train_percent: int = 80,
    keep_percent: int = 100,
    stratified: bool = True,
) -> Prepared:
    """Clean, optionally add noise, drop classes of two rows or fewer, split (by class, if ``stratified``), subsample
    the training rows, scale both ways, assign folds, and settle the result.

    Rows without a label are left out, and so are rows with a feature that is no number; the latter are counted.
    """
    numbers = {c: F.col(c).try_cast("double") for c in features}
    rows = df.select(F.col(key).alias("key"), F.col(label).try_cast("bigint").alias("label"), *[
        c.alias(n) for n, c in numbers.items()
    ])
    if noise_level:
        rows = add_noise(rows, "key", features, noise_level, seed)
    usable = F.lit(True)
    for c in features:
        usable &= F.col(c).isNotNull() & ~F.isnan(c)
    read = settle(rows.filter("label is not null").withColumn("_usable", usable), "model-input")
    unusable = read.filter("not _usable").count()
    # Settled before it is ranked, since ranking reads its input twice.
    rows = settle(split.without_rare_classes(read.filter("_usable").drop("_usable"), "label"), "model-classes")
    rows = settle(split.split(rows, "key", ["label"] if stratified else [], train_percent, seed), "model-rows")
    train = rows.filter("part = 'train'")
    if keep_percent < 100:
        kept = split.sample(train, "key", keep_percent, seed)
        rows = settle(kept.unionByName(rows.filter("part = 'test'")), "model-rows")
        train = rows.filter("part = 'train'")
    # One row per class.
    sizes = rows.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("part") == "train").alias("t")).collect()
    if sum(r.n for r in sizes) < MIN_ROWS:
        raise ValueError(f"fewer than {MIN_ROWS} rows are left to train and test on")
    classes = sorted(r.label for r in sizes)
    folds = split.fold_count(min(r.t for r in sizes if r.t))
    std, minmax = scale.fit_standard(train, features), scale.fit_minmax(train, features)

    def scaled(scaler):
        return F.array(*[(F.col(c) - scaler.offset[c]) / scaler.width[c] for c in features])

    index = map_values("label", {c: float(i) for i, c in enumerate(classes)})
    shaped = split.folds(rows, "key", "label", folds, seed).select(
        "key", "label", index.alias("idx"), "part", "fold", scaled(std).alias("standard"), scaled(minmax).alias("minmax")
    )
    shape = models.Rows(classes, len(features), sum(r.t for r in sizes))
    # With one training row of a class, the fold that holds it would be judged by a model that has never seen the class.
    few = [r.label for r in sizes if r.t < 2]
    no_folds = f"classes with fewer than 2 training rows: {few}" if few else None
    return Prepared(settle(shaped, "model-set"), shape, folds, std, minmax, tuple(features), unusable, no_folds)


def _accuracy(scored: DataFrame) -> float | None:
    """NULL without a row to judge by."""
    return evaluate.accuracy(scored).first()["accuracy"]


def cross_validate(name: str, params, data: Prepared, seed: int, scaling: str | None = None) -> tuple[float | None, float | None]:
    """Mean and population deviation of the accuracy over the folds of the training rows; NULL if there can be no folds."""
    if data.no_folds:
        return None, None
    train = data.part("train", scaling or models.scaling_of(name))
    scores = []
    for fold in range(data.folds):
        predictor = models.fit(name, params, train.filter(F.col("fold") != fold), data.rows, seed)
        scores.append(_accuracy(predictor(train.filter(F.col("fold") == fold))))
    return fmean(scores), pstdev(scores)


def _evaluate(name: str, params, data: Prepared, seed: int, scaling: str | None = None):
    """(predictor, accuracy, cv mean, cv std, test predictions)."""
    scaling = scaling or models.scaling_of(name)
    predictor = models.fit(name, params, data.part("train", scaling), data.rows, seed)
    scored = settle(predictor(data.part("test", scaling)).select("key", "label", "prediction"), "scored")
    mean, std = cross_validate(name, params, data, seed, scaling)
    return predictor, _accuracy(scored), mean, std, scored


@dataclass(frozen=True)
class Comparison:
    results: DataFrame
    best: str
    predictor: models.Predictor
    reports: dict[str, DataFrame]


def compare_models(
    data: Prepared,
    names: Sequence[str] = tuple(models.DESCRIPTIONS),
    class_names: dict[int, str] | None = None,
    seed: int = 42,
    at: dt.datetime = dt.datetime(1970, 1, 1),
    parameters: Mapping[str, Mapping] = models.DEFAULTS,
) -> Comparison:
    """Train every model and keep its scores and majority class; the best one is the first with the top accuracy."""
    spark = data.frame.sparkSession
    class_names = models.PARTY_LABELS if class_names is None else class_names
    with ThreadPoolExecutor(THREADS) as pool:
        done = dict(zip(names, pool.map(lambda n: _evaluate(n, parameters[n], data, seed), names)))
    rows = []
    for position, name in enumerate(names, 1):
        _, accuracy, mean, std, scored = done[name]
        top = majority(scored, "prediction").first()
        winner = (top["prediction"], class_names.get(top["prediction"], "Unknown"), top["pct"]) if top else (None, None, None)
        rows.append((position, at, name, models.DESCRIPTIONS.get(name, ""), accuracy, mean, std, *winner, data.no_folds))
    results = spark.createDataFrame(rows, RESULTS)
    best = max(rows, key=lambda r: -1.0 if r[4] is None else r[4])[2]
    reports = {name: evaluate.class_report(done[name][4]) for name in names}
    return Comparison(results, best, done[best][0], reports)


def predict_years(
    comparison: Comparison,
    data: Prepared,
    unlabelled: DataFrame,
    key: str,
    years: Sequence[int],
    valid: Iterable[int],
    labelled: Iterable[int],
) -> DataFrame:
    """(key, prediction, year) of the unlabelled rows of the chosen years, by the best model, in one pass."""
    chosen = keep_chosen_years(unlabelled, key, years, valid, labelled)
    ready = data.ready(chosen, key, models.scaling_of(comparison.best))
    return comparison.predictor(ready).select("key", "prediction", panel_key_year("key").alias("year"))


def yearly_models(
    df: DataFrame, key: str, label: str, features: Sequence[str], best: str, years: Sequence[int], noise_level: float = 0.3
) -> DataFrame:
    """One variant of the best model per year: its own 80 % sample, split, scaling and parameters.

    The samples are drawn from rows with noise, the same for all years; every variant gets standard scaling.
    """
    spark = df.sparkSession
    numbers = [F.col(c).try_cast("double").alias(c) for c in features]
    source = df.select(key, label, *numbers)
    source = settle(add_noise(source, key, features, noise_level, 42) if noise_level else source, "yearly-source")

    def one(year: int):
        sampled = split.sample(source, key, 80, year)
        data = prepare(sampled, key, label, features, seed=year)
        _, accuracy, mean, std, _ = _evaluate(best, models.yearly_parameters(best, year), data, year, "standard")
        return year, best, accuracy, mean, std, data.no_folds

    with ThreadPoolExecutor(THREADS) as pool:
        rows = list(pool.map(one, years))
    return spark.createDataFrame(rows, "year int, model_name string, accuracy double, cv_mean double, cv_std double, note string")


def yearly_results(predicted: DataFrame, yearly: DataFrame, class_names: dict[int, str], at: dt.datetime) -> DataFrame:
    """Result rows of the predicted years: majority class of the predictions, scores of the year's model."""
    top = majority(predicted, "prediction", ["year"])
    description = F.concat(
        map_values("model_name", models.DESCRIPTIONS, ""), F.lit(" résultat  pour l'année "), F.col("year").cast("string")
    )
    return top.join(yearly, "year").select(
        F.lit(None).cast("bigint").alias("position"),
        F.lit(at).alias("run_timestamp"),
        "model_name",
        description.alias("description"),
        "accuracy",
        "cv_mean",
        "cv_std",
        F.col("prediction").cast("bigint").alias("winner_id"),
        map_values(F.col("prediction").cast("int"), class_names, "Unknown").alias("winner_name"),
        F.col("pct").alias("winner_pct"),
        "note",
    )


# The forest grid.  Depth 0 stands for unlimited; ``split`` is the least rows of a node that is split.
FOREST_GRID = {"trees": (50, 100, 200), "depth": (0, 10, 20), "split": (2, 5, 10)}


@dataclass(frozen=True)
class GridSearch:
    """``by_fold``: accuracy and rows of every cell and fold; ``scores``: mean and deviation by cell; ``best``: the best cell, the first of equals."""

    by_fold: DataFrame
    scores: DataFrame
    best: forest.Cell
    grown: forest.Grown
    folds: int


def grid_search(data: Prepared, grid: dict[str, Sequence[int]] = FOREST_GRID, seed: int = 42) -> GridSearch:
    """Every forest of the grid on the folds of the training rows, and on all of them for the test rows; see :mod:`panelspark.ml.forest`."""
    features, classes = len(data.features), len(data.rows.classes)
    rows = data.frame.select("key", "idx", "part", "fold", F.col("standard").alias("v"))
    rows = settle(forest.binned(rows, features).drop("v"), "forest-bins")
    grown = forest.grow(rows, data.folds, features, classes, grid, seed)
    by_fold = settle(forest.scores(grown, data.folds, classes, grid), "forest-scores")
    scores = by_fold.filter(F.col("fold") < data.folds).groupBy("trees", "depth", "split").agg(
        F.avg("accuracy").alias("cv_mean"), F.stddev_pop("accuracy").alias("cv_std")
    )
    # One row for each cell of the grid.
    ranked = sorted(scores.collect(), key=lambda r: (-round(r.cv_mean, 9), r.trees, r.depth or forest.DEEPEST, r.split))
    best = forest.Cell(ranked[0].trees, ranked[0].depth, ranked[0].split)
    return GridSearch(by_fold, scores, best, grown, data.folds)


def importances(search: GridSearch, features: Sequence[str]) -> DataFrame:
    """Feature importances of the best forest of a search, fitted to all training rows, the largest first."""
    found = forest.importances(search.grown, search.folds, search.best, len(features))
    names = F.array(*[F.lit(n) for n in features])
    return found.select(F.get(names, F.col("feature")).alias("feature"), "importance").orderBy(F.desc("importance"), "feature")
