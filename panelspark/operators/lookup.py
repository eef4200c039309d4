"""Value mapping and lookups.

No join here carries a broadcast hint: Catalyst broadcasts a side only when its
measured size is below ``spark.sql.autoBroadcastJoinThreshold`` (file statistics
at planning time, real sizes under adaptive execution) and shuffles otherwise,
splitting skewed partitions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEEP = object()


def map_values(c: Column | str, mapping: Mapping, default: object = None) -> Column:
    """Replace by a small literal dictionary; misses give NULL, ``KEEP`` the input, or a literal."""
    c = F.col(c) if isinstance(c, str) else c
    table = F.create_map(*[F.lit(v) for v in chain.from_iterable(mapping.items())])
    found = F.element_at(table, c)
    if default is KEEP:
        return F.coalesce(found, c)
    return found if default is None else F.coalesce(found, F.lit(default))


def map_from_table(
    df: DataFrame, on: str, lookup: DataFrame, key: str, value: str, alias: str, default: object = None
) -> DataFrame:
    """Left lookup in a table, one value (the smallest) per key, so rows never multiply."""
    pairs = lookup.groupBy(F.col(key).alias("_key")).agg(F.min(value).alias(alias))
    out = df.join(pairs, F.col(on) == F.col("_key"), "left").drop("_key")
    return out if default is None else out.withColumn(alias, F.coalesce(alias, F.lit(default)))


def fan_out(regional: DataFrame, units: DataFrame, region: str) -> DataFrame:
    """Copy each regional row to all units of the region."""
    return units.join(regional, region).drop(region)


def rows_with_match(df: DataFrame, other: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key occurs in ``other``; ``other`` is reduced to its keys before the shuffle."""
    return df.join(other.select(*on).distinct(), list(on), "left_semi")


def rows_without_match(df: DataFrame, other: DataFrame, on: Sequence[str]) -> DataFrame:
    return df.join(other.select(*on).distinct(), list(on), "left_anti")


def add_missing_units(df: DataFrame, reference: DataFrame, unit: str, constants: Mapping[str, Column]) -> DataFrame:
    """Append one row per unit of ``reference`` that ``df`` lacks; other columns become NULL."""
    missing = rows_without_match(reference.select(unit).distinct(), df, [unit])
    return df.unionByName(missing.withColumns(dict(constants)), allowMissingColumns=True)
