"""Hard voting."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.sources.delimited import stack


def hard_vote(predictions: Sequence[DataFrame], key: str) -> DataFrame:
    """Most frequent prediction per row; ties go to the smallest class."""
    ballots = stack([p.select(key, "prediction") for p in predictions])
    counts = ballots.groupBy(key, "prediction").agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy(key).agg(
        F.min_by("prediction", F.struct(-F.col("n"), F.col("prediction"))).alias("prediction")
    )
