"""Exact ranks and dense ids without sorting a group in one task.

Rows are ordered by an MD5 digest.  They are numbered inside slices of the digest space and
shifted by the sizes of the slices before them; digests are uniform, so a group that holds a
third of all rows is spread over thousands of slices like any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a slice that one task numbers, on average.
SLICE_ROWS = 200_000


def slice_digits(rows: int) -> int:
    """Hexadecimal digits of the digest, so that all rows in one stratum still make slices of bounded size.

    Two at least; the ranks do not depend on it.
    """
    digits = 2
    while rows > SLICE_ROWS * 16**digits:
        digits += 1
    return digits


def _sliced(df: DataFrame, digest: Column, ties: Sequence[str], strata: Sequence[str], digits: int) -> tuple[DataFrame, DataFrame]:
    """(rows numbered inside their slice as ``_within``, number of rows ``_n`` per slice), both with ``_group``."""
    # A struct, so that rows without a stratum value form a stratum of their own and join like any other.
    slice_ = F.substring("_digest", 1, digits).alias("slice")
    rows = df.withColumn("_digest", digest).withColumn(
        "_group", F.struct(F.struct(F.lit(0).alias("all"), *strata).alias("stratum"), slice_)
    )
    within = F.row_number().over(Window.partitionBy("_group").orderBy("_digest", *ties))
    sizes = rows.groupBy("_group").agg(F.count(F.lit(1)).alias("_n"))
    return rows.withColumn("_within", within), sizes


def rank_by_digest(df: DataFrame, digest: Column, ties: Sequence[str], strata: Sequence[str] = ()) -> DataFrame:
    """Add ``_rank`` (1-based, by digest and then ``ties``, within the stratum) and ``_size`` of the stratum."""
    rows, sizes = _sliced(df, digest, ties, strata, slice_digits(df.count()))
    # One row per slice.
    stratum = Window.partitionBy("_group.stratum")
    before = stratum.orderBy("_group.slice").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select(
        "_group", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"), F.sum("_n").over(stratum).alias("_size")
    )
    ranked = rows.join(shifts, "_group").withColumn("_rank", F.col("_shift") + F.col("_within"))
    return ranked.drop("_digest", "_group", "_within", "_shift")


def surrogate_id(df: DataFrame, leading: str, rest: Sequence[str], name: str = "id") -> DataFrame:
    """Dense ids 1, 2, 3, …: by the leading key column (the year), then by the digest of the rest.

    The same natural keys always get the same ids.  The running sum goes over one row per slice within a value of the
    leading column, and over one row per value; not over the rows themselves.
    """
    digest = F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in rest]))
    rows, sizes = _sliced(df, digest, rest, [leading], slice_digits(df.count()))
    earlier = Window.unboundedPreceding, -1
    within = Window.partitionBy("_group.stratum").orderBy("_group.slice").rowsBetween(*earlier)
    sizes = sizes.withColumn("_inner", F.coalesce(F.sum("_n").over(within), F.lit(0)))
    # One row per value of the leading column (a year).
    strata = sizes.groupBy(F.col("_group.stratum").alias("_stratum")).agg(F.sum("_n").alias("_all"))
    strata = strata.withColumn("_outer", F.coalesce(F.sum("_all").over(Window.orderBy("_stratum").rowsBetween(*earlier)), F.lit(0)))
    shifts = sizes.join(strata, F.col("_group.stratum") == F.col("_stratum")).select("_group", (F.col("_inner") + F.col("_outer")).alias("_shift"))
    joined = rows.join(shifts, "_group").withColumn(name, F.col("_shift") + F.col("_within"))
    return joined.drop("_digest", "_group", "_within", "_shift")
