"""Repeatable splits, samples and folds.

Rows are ranked by the MD5 digest of key and seed, so a split is exact in size, the same on
every run, and independent of how rows are spread over tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.operators.numbering import rank_by_digest


def digest_rank(df: DataFrame, key: str, strata: Sequence[str] = (), seed: int = 42) -> DataFrame:
    """Add ``_rank`` (1-based, in digest order within the stratum) and ``_size`` of the stratum."""
    return rank_by_digest(df, F.md5(F.concat(F.col(key).cast("string"), F.lit(f"|{seed}"))), [key], strata)


def _share(percent: int):
    return F.ceil(F.col("_size") * percent / 100)


def split(df: DataFrame, key: str, strata: Sequence[str] = (), percent: int = 80, seed: int = 42) -> DataFrame:
    """Add ``part``: "train" for ``percent`` of every stratum (rounded up), "test" for the rest."""
    ranked = digest_rank(df, key, strata, seed)
    part = F.when(F.col("_rank") <= _share(percent), F.lit("train")).otherwise(F.lit("test"))
    return ranked.withColumn("part", part).drop("_rank", "_size")


def sample(df: DataFrame, key: str, percent: int = 50, seed: int = 42) -> DataFrame:
    """An exact ``percent`` of the rows (rounded up)."""
    ranked = digest_rank(df, key, (), seed)
    return ranked.filter(F.col("_rank") <= _share(percent)).drop("_rank", "_size")


def folds(df: DataFrame, key: str, label: str, k: int, seed: int = 42) -> DataFrame:
    """Add ``fold`` 0 … k-1, balanced within every class."""
    ranked = digest_rank(df, key, [label], seed)
    return ranked.withColumn("fold", ((F.col("_rank") - 1) % k).cast("int")).drop("_rank", "_size")


def without_rare_classes(df: DataFrame, label: str, more_than: int = 2) -> DataFrame:
    """Keep the rows of classes with more than ``more_than`` samples; rows without a label are no class and go."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    return df.join(counts.filter(F.col("_n") > more_than).select(label), label, "left_semi")


def fold_count(smallest_class: int) -> int:
    """Number of folds: the size of the smallest class, but 2 at least and 5 at most."""
    return max(2, min(5, smallest_class))
