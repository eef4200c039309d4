"""Constraint checks as queries: keys, references, missing values, empty rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.filter(F.col("n_rows") > 1)


def orphan_keys(df: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Foreign keys without a parent row, with their number of rows.

    Rows are counted per key first: a key that fills a third of the table is one row in the join.
    """
    counts = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.join(parent.select(F.col(parent_key).alias(key)), key, "left_anti")


def missing_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Number of NULLs per column that must not hold any, in one pass."""
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return wide.unpivot([], list(columns), "column", "n_missing")


def without_empty_rows(df: DataFrame) -> DataFrame:
    return df.na.drop("all")
