"""Seeded Gaussian noise on features."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def gaussian(key: str, column: str, seed: int) -> Column:
    """Standard normal number of a row, from the digest of its key (Box-Muller).

    Unlike ``randn`` it does not depend on the partition a row is in, so a recomputed task
    yields the same noise.
    """
    code = F.md5(F.concat(F.col(key).cast("string"), F.lit(f"|{seed}|{column}")))
    span = float(16**13)

    def uniform(start: int) -> Column:
        return (F.conv(F.substring(code, start, 13), 16, 10).cast("bigint") + 1) / F.lit(span)

    return F.sqrt(-2 * F.ln(uniform(1))) * F.cos(2 * math.pi * uniform(14))


def add_noise(df: DataFrame, key: str, columns: Sequence[str], level: float = 0.3, seed: int = 42) -> DataFrame:
    """Add noise with ``level`` times the sample deviation of each column."""
    spread = df.agg(F.struct(*[F.stddev_samp(c).alias(c) for c in columns]).alias("s")).scalar()
    return df.withColumns({c: F.col(c) + gaussian(key, c, seed) * level * spread[c] for c in columns})
