"""Classifiers by name, with the default and the year-dependent hyper-parameters.

Spark estimators stand for their single-machine namesakes.  Where Spark has no such
parameter (minimum samples to split, mini-batch size) it is left out; boosting and
regularised regression are one-vs-rest, since they are binary in Spark or in the original.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    OneVsRest,
    RandomForestClassifier,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.ml import knn
from panelspark.ml.vote import hard_vote

# Class names by id, model names with their descriptions (in evaluation order).
PARTY_LABELS = {
    1: "Extrême Gauche",
    2: "Gauche",
    3: "Centre Gauche",
    4: "Centre",
    5: "Centre Droite",
    6: "Droite",
    7: "Extrême Droite",
}
DESCRIPTIONS = {
    "Logistic Regression": "Régression logistique",
    "Random Forest": "Forêt aléatoire",
    "Gradient Boosting": "Gradient Boosting",
    "KNN": "K plus proches voisins",
    "MLP (Neural Net)": "Perceptron multicouche",
    "Decision Tree": "Arbre de décision",
    "Voting Ensemble": "Ensemble par vote (KNN, RF, DT)",
}

# Hyper-parameters of the general models.
DEFAULTS: dict[str, dict] = {
    "Logistic Regression": {"c": 0.001, "iterations": 50},
    "Random Forest": {"trees": 5, "depth": 2, "leaf": 10},
    "Gradient Boosting": {"stages": 3, "rate": 0.01, "depth": 1, "subsample": 0.5},
    "KNN": {"k": 2, "weights": "uniform", "metric": "manhattan"},
    "MLP (Neural Net)": {"hidden": 3, "rate": 0.001, "iterations": 20},
    "Decision Tree": {"depth": 1, "leaf": 10, "impurity": "gini"},
    "Voting Ensemble": {
        "tree": {"depth": 1, "leaf": 10, "impurity": "gini"},
        "knn": {"k": 2, "weights": "uniform", "metric": "manhattan"},
    },
}


# Hyper-parameters of the stronger models, which are compared on a plain 70/30 split.
STRONG: dict[str, dict] = {
    **DEFAULTS,
    "Logistic Regression": {"c": 1.0, "iterations": 1000},
    "Random Forest": {"trees": 100, "depth": 30, "leaf": 1},
    "Gradient Boosting": {"stages": 100, "rate": 0.1, "depth": 3, "subsample": 1.0},
    "MLP (Neural Net)": {"hidden": (100, 50), "rate": 0.001, "iterations": 1000},
}


def yearly_parameters(name: str, year: int) -> dict:
    """Hyper-parameters of the variant of a model that is trained for one year."""
    even, digit = year % 2 == 0, year % 10
    neighbour_style = {"weights": "uniform" if even else "distance"}
    # The formulae by which parameters vary with the year.
    variants = {
        "Logistic Regression": {"c": 0.001 * (1 + 0.05 * digit), "iterations": 50 + year % 50},
        "Random Forest": {"trees": 5 + 2 * (year % 7), "depth": 2 + year % 3, "leaf": 5 + digit},
        "Gradient Boosting": {
            "stages": 3 + year % 7,
            "rate": 0.01 * (0.5 + 0.1 * digit),
            "depth": 1 + year % 3,
            "subsample": 0.5 + digit / 20,
        },
        "KNN": {"k": 2 + year % 5, "metric": "manhattan" if even else "euclidean", **neighbour_style},
        "MLP (Neural Net)": {
            "hidden": 3 + year % 5,
            "rate": 0.001 * (0.5 + 0.1 * digit),
            "iterations": 20 + year % 30,
        },
        "Decision Tree": {"depth": 1 + year % 5, "leaf": 10 - year % 9, "impurity": "gini" if even else "entropy"},
        "Voting Ensemble": {
            "tree": {"depth": 1 + year % 4, "leaf": 1, "impurity": "gini"},
            "knn": {"k": 2 + year % 3, "metric": "euclidean", **neighbour_style},
        },
    }
    return variants.get(name, {"depth": 2 + year % 3, "leaf": 1, "impurity": "gini"})


@dataclass(frozen=True)
class Rows:
    """How training rows look: ``key``, ``label`` (class id), ``idx`` (0 … classes-1), ``v`` (array), ``x`` (vector)."""

    classes: Sequence[int]
    features: int
    n: int
    key: str = "key"


Predictor = Callable[[DataFrame], DataFrame]


def scaling_of(name: str) -> str:
    return "minmax" if name == "KNN" else "standard"


def fit(name: str, params: Mapping, train: DataFrame, rows: Rows, seed: int) -> Predictor:
    """Train a model; the predictor adds ``prediction`` (a class id) to the rows it is given."""
    if name == "KNN":
        return _knn(params, train, rows)
    if name == "Voting Ensemble":
        members = [fit("Decision Tree", params["tree"], train, rows, seed), fit("KNN", params["knn"], train, rows, seed)]
        return lambda df: df.join(hard_vote([m(df) for m in members], rows.key), rows.key)
    model = _estimator(name, params, rows, seed).fit(train)
    class_of = F.array(*[F.lit(c) for c in rows.classes])

    def classify(df: DataFrame) -> DataFrame:
        scored = model.transform(df).withColumnRenamed("prediction", "_index")
        return scored.select(*df.columns, F.get(class_of, F.col("_index").cast("int")).alias("prediction"))

    return classify


def _knn(params: Mapping, train: DataFrame, rows: Rows) -> Predictor:
    def classify(df: DataFrame) -> DataFrame:
        voted = knn.predict(
            train, df, rows.key, "v", "label", params["k"], params.get("metric", "manhattan"), params["weights"]
        )
        return df.join(voted, rows.key)

    return classify


def _estimator(name: str, params: Mapping, rows: Rows, seed: int):
    columns = {"featuresCol": "x", "labelCol": "idx"}
    if name == "Logistic Regression":
        # Inverse strength summed over rows becomes a penalty averaged over rows.
        penalty = 1.0 / (params["c"] * max(rows.n, 1))
        binary = LogisticRegression(
            maxIter=params["iterations"], regParam=penalty, elasticNetParam=0.0, standardization=False, **columns
        )
        return OneVsRest(classifier=binary, parallelism=min(8, len(rows.classes)), **columns)
    if name == "Random Forest":
        return RandomForestClassifier(
            numTrees=params["trees"], maxDepth=params["depth"], minInstancesPerNode=params["leaf"], seed=seed, **columns
        )
    if name == "Gradient Boosting":
        binary = GBTClassifier(
            maxIter=params["stages"],
            stepSize=params["rate"],
            maxDepth=params["depth"],
            subsamplingRate=params["subsample"],
            seed=seed,
            **columns,
        )
        return OneVsRest(classifier=binary, parallelism=min(8, len(rows.classes)), **columns)
    if name == "MLP (Neural Net)":
        hidden = [params["hidden"]] if isinstance(params["hidden"], int) else params["hidden"]
        return MultilayerPerceptronClassifier(
            layers=[rows.features, *hidden, len(rows.classes)],
            solver="gd",
            stepSize=params["rate"],
            maxIter=params["iterations"],
            seed=seed,
            **columns,
        )
    return DecisionTreeClassifier(
        maxDepth=params["depth"], minInstancesPerNode=params["leaf"], impurity=params["impurity"], seed=seed, **columns
    )
