"""Scores of predictions as tables.  Rows are counted once; everything else works on the counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.sources.delimited import stack


def confusion(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """(label, prediction, n) of every pair that occurs."""
    return df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count(F.lit(1)).alias("n")
    )


def accuracy(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row: accuracy and number of rows."""
    hit = F.col(label) == F.col(prediction)
    return df.agg((F.count_if(hit) / F.count(F.lit(1))).alias("accuracy"), F.count(F.lit(1)).alias("n_rows"))


def _ratio(a, b):
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def class_report(df: DataFrame, label: str = "label", prediction: str = "prediction", digits: int = 6) -> DataFrame:
    """Precision, recall, F1 and support per class, then accuracy, macro and weighted averages.

    A ratio without denominator is 0.
    """
    pairs = confusion(df, label, prediction)
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(F.lit(0))
    per_class = (
        stack(
            [
                pairs.select(F.col("label").alias("class"), F.col("n").alias("support"), hit.alias("tp")),
                pairs.select(F.col("prediction").alias("class"), F.col("n").alias("predicted")),
            ]
        )
        .groupBy("class")
        .agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("support", "tp", "predicted")])
    )
    scored = per_class.select(
        "class",
        _ratio(F.col("tp"), F.col("predicted")).alias("precision"),
        _ratio(F.col("tp"), F.col("support")).alias("recall"),
        "support",
        "tp",
    ).withColumn(
        "f1", _ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
    )
    names = ["precision", "recall", "f1"]
    total = F.sum("support")
    hits = F.sum("tp") / total
    rows = scored.select(F.col("class").cast("string").alias("name"), *names, "support")
    overall = scored.agg(
        F.array(
            F.struct(
                F.lit("accuracy").alias("name"), *[hits.alias(c) for c in names], total.alias("support")
            ),
            F.struct(F.lit("macro avg").alias("name"), *[F.avg(c).alias(c) for c in names], total.alias("support")),
            F.struct(
                F.lit("weighted avg").alias("name"),
                *[(F.sum(F.col(c) * F.col("support")) / total).alias(c) for c in names],
                total.alias("support"),
            ),
        ).alias("rows")
    ).select(F.inline("rows"))
    full = rows.unionByName(overall)
    return full.select("name", *[F.round(c, digits).alias(c) for c in names], "support")


def best_model(results: DataFrame, score: str = "accuracy", position: str = "position") -> DataFrame:
    """The row with the highest score, the first one on ties."""
    return results.orderBy(F.desc_nulls_last(score), F.asc(position)).limit(1)
