"""Scoring of unlabelled years."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.functions.text import panel_key_year


def check_years(years: Sequence[int], valid: Iterable[int], labelled: Iterable[int]) -> None:
    """Raise if a chosen year already has a label or lies outside the valid range."""
    valid, labelled = set(valid), set(labelled)
    wrong = [f"{y} (already labelled)" for y in years if y in labelled]
    wrong += [f"{y} (outside {min(valid)}-{max(valid)})" for y in years if y not in valid]
    if wrong:
        allowed = sorted(valid - labelled)
        raise ValueError(f"years that cannot be predicted: {', '.join(wrong)}; choose from {allowed}")


def keep_chosen_years(
    df: DataFrame, key: str, years: Sequence[int], valid: Iterable[int], labelled: Iterable[int]
) -> DataFrame:
    """Rows of the chosen years; none when none of them occurs."""
    check_years(years, valid, labelled)
    return df.filter(panel_key_year(key).isin(list(years)))


def feature_rows(df: DataFrame, key: str, label: str, features: Sequence[str]) -> DataFrame:
    """Key, label and numeric features; a feature that is no number becomes NULL."""
    numbers = [F.col(c).try_cast("double").alias(c) for c in features]
    return df.select(key, F.col(label).try_cast("bigint").alias("label"), *numbers)


def first_features(df: DataFrame, label: str, key: str, at_most: int | None = None) -> list[str]:
    """The columns that are neither label nor key: all, or the first ``at_most``."""
    return [c for c in df.columns if c not in (label, key)][:at_most]


def as_vector(df: DataFrame, features: Sequence[str], name: str) -> DataFrame:
    """Features as one array column."""
    return df.withColumn(name, F.array(*features))
