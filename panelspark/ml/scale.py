"""Scaling with moments of the training rows.

The moments are one scalar subquery over the training rows, so scaling stays part of the plan.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Scaler:
    """``(x - offset) / width`` per column."""

    offset: dict[str, Column]
    width: dict[str, Column]

    def apply(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: (F.col(c) - self.offset[c]) / self.width[c] for c in self.offset})


def _fit(train: DataFrame, columns: Sequence[str], offset, width) -> Scaler:
    moments = train.agg(
        F.struct(*[F.struct(offset(F.col(c)).alias("o"), width(F.col(c)).alias("w")).alias(c) for c in columns]).alias("m")
    ).scalar()
    # A constant column has no width; dividing by one leaves it at zero.
    widths = {c: F.when(moments[c]["w"] == 0, F.lit(1.0)).otherwise(moments[c]["w"]) for c in columns}
    return Scaler({c: moments[c]["o"] for c in columns}, widths)


def fit_standard(train: DataFrame, columns: Sequence[str]) -> Scaler:
    """Mean 0 and population deviation 1 on the training rows."""
    return _fit(train, columns, F.avg, F.stddev_pop)


def fit_minmax(train: DataFrame, columns: Sequence[str]) -> Scaler:
    """Range 0 … 1 on the training rows."""
    return _fit(train, columns, F.min, lambda c: (F.max(c) - F.min(c)).cast("double"))
