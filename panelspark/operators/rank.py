"""Per-group selection: winners, majorities, latest versions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_per_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1, rank_as: str | None = None
) -> DataFrame:
    """The first ``n`` rows of every group.

    ``row_number() <= n`` is planned as a group limit below the shuffle, so each
    map task sends at most ``n`` rows per key and a hot key cannot pile up.
    ``order`` must be total for a repeatable answer.
    """
    rank = rank_as or "_rank"
    out = df.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    out = out.filter(F.col(rank) <= n)
    return out if rank_as else out.drop(rank)


def total_by(df: DataFrame, keys: Sequence[str], value: str, total: str) -> DataFrame:
    """Sum per key, so duplicate rows of a key collapse."""
    return df.groupBy(*keys).agg(F.sum(value).alias(total))


def winner(
    df: DataFrame, keys: Sequence[str], candidate: str, value: str, total: str, digits: int | None = None
) -> DataFrame:
    """Candidate with the largest summed value per group; ties go to the first name."""
    summed = F.sum(value) if digits is None else F.round(F.sum(value), digits)
    totals = df.groupBy(*keys, candidate).agg(summed.alias(total))
    return top_per_group(totals, keys, [F.desc_nulls_last(total), F.asc(candidate)])


def _label_counts(df: DataFrame, label: str, by: Sequence[str], weight: str | None) -> DataFrame:
    rows = F.count(F.lit(1)) if weight is None else F.sum(weight)
    return df.groupBy(*by, label).agg(rows.alias("n"))


def distribution(
    df: DataFrame, label: str, by: Sequence[str] = (), digits: int = 4, weight: str | None = None
) -> DataFrame:
    """Count and percentage of every label, per ``by`` group; ``weight`` holds counts of pre-aggregated rows.

    The raw rows are only counted; totals come from the counts, so no group of rows
    ever meets in one task.
    """
    counts = _label_counts(df, label, by, weight)
    if by:
        totals = counts.groupBy(*by).agg(F.sum("n").alias("n_rows"))
        joined = counts.join(totals, list(by))
    else:
        total = counts.agg(F.sum("n")).scalar()
        joined = counts.withColumn("n_rows", total)
    return joined.withColumn("pct", F.round(F.col("n") * 100.0 / F.col("n_rows"), digits))


def majority(
    df: DataFrame, label: str, by: Sequence[str] = (), digits: int = 4, weight: str | None = None
) -> DataFrame:
    """Most frequent label per group with its count and share; ties go to the smallest label."""
    counts = _label_counts(df, label, by, weight)
    picked = counts.groupBy(*by).agg(
        F.min_by(label, F.struct(-F.col("n"), F.col(label))).alias(label),
        F.max("n").alias("n"),
        F.sum("n").alias("n_rows"),
    )
    return picked.withColumn("pct", F.round(F.col("n") * 100.0 / F.col("n_rows"), digits))


def upsert_latest(base: DataFrame, delta: DataFrame, keys: Sequence[str], version: str, ties: Sequence[str]) -> DataFrame:
    """Insert-or-update: the newest version of each key wins, the delta on equal versions, the smallest ``ties`` among its rows."""
    stacked = base.withColumn("_from", F.lit(0)).unionByName(delta.withColumn("_from", F.lit(1)))
    order = [F.desc_nulls_last(version), F.desc("_from"), *[F.asc_nulls_last(t) for t in ties]]
    return top_per_group(stacked, keys, order).drop("_from")


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()
