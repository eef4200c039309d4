"""Gap filling by a straight line per unit."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.functions.numbers import truncate


def ols_fill(
    df: DataFrame,
    unit: Sequence[str],
    x: str,
    y: str,
    post: str = "trunc",
    digits: int = 2,
    only: Column | None = None,
) -> DataFrame:
    """Fill missing ``y`` with the least-squares line of the unit's known points.

    ``post="trunc"`` truncates the predictions, ``post="round"`` rounds every value.
    ``only`` restricts the filling to some units.  A unit with fewer than two distinct known years keeps its gaps.  The line is one
    grouped aggregate for all units at once; it is evaluated around the mean of ``x``
    so that year numbers near 2000 cost no precision.
    """
    # The regression functions skip rows without x or y by themselves.  With no filter here, and a
    # null-safe join that infers none, both uses of ``df`` are the same plan and run once.
    point = (F.col(y).cast("double"), F.col(x).cast("double"))
    lines = df.groupBy(*[F.col(c).alias(f"_{c}") for c in unit]).agg(
        F.regr_slope(*point).alias("_slope"), F.regr_avgx(*point).alias("_mean_x"), F.regr_avgy(*point).alias("_mean_y")
    )
    same_unit = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in unit]
    predicted = F.col("_mean_y") + F.col("_slope") * (F.col(x) - F.col("_mean_x"))
    if post == "trunc":
        # Points on a line may predict 9.999999999 for 10; rounding far behind the point undoes that.
        filled = F.coalesce(F.col(y).cast("double"), truncate(F.round(predicted, 6)).cast("double"))
    elif post == "round":
        filled = F.round(F.coalesce(F.col(y).cast("double"), predicted), digits)
    else:
        raise ValueError(f"unknown post-processing {post!r}")
    if only is not None:
        filled = F.when(only, filled).otherwise(F.col(y).cast("double"))
    made = ["_slope", "_mean_x", "_mean_y", *[f"_{c}" for c in unit]]
    return df.join(lines, same_unit, "left").withColumn(y, filled).drop(*made)
