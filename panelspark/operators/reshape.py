"""Wide ↔ long, month columns to years, dense grids, baselines."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def to_long(
    df: DataFrame,
    ids: Sequence[str],
    values: Sequence[str],
    name: str,
    value: str,
    value_type: str = "double",
) -> DataFrame:
    """One row per (ids, column); cells that are no number become NULL."""
    cells = [F.col(f"`{c}`").try_cast(value_type).alias(c) for c in values]
    ids_cols = [F.col(f"`{c}`") for c in ids]
    return df.select(*ids_cols, *cells).unpivot(list(ids), [F.col(f"`{c}`") for c in values], name, value)


def to_wide(df: DataFrame, keys: Sequence[str], name: str, labels: Sequence[str], agg: Column) -> DataFrame:
    """One column per listed label; listing them saves Spark a pass over the data."""
    return df.groupBy(*keys).pivot(name, list(labels)).agg(agg)


def month_columns_to_years(
    df: DataFrame,
    keys: Sequence[str],
    pattern: str = r"^_(\d{4})_\d{2}$",
    year: str = "year",
    total: str = "total",
    years: range | None = None,
    keep_empty: bool = True,
) -> DataFrame:
    """Sum ``_YYYY_MM`` columns over all rows of a key into one row per (key, year).

    A year without a single number gets 0, or no row at all without ``keep_empty``; numbers that add up to 0 always stay.

    The months of a year are added inside the row and the rows inside the map tasks,
    so only one number per key and year is shuffled.
    """
    months: dict[int, list[str]] = {}
    for column in df.columns:
        if found := re.match(pattern, column):
            if years is None or int(found.group(1)) in years:
                months.setdefault(int(found.group(1)), []).append(column)
    def of_year(columns: list[str]) -> Column:
        values = [F.col(c).try_cast("double") for c in columns]
        some = F.coalesce(*values).isNotNull()
        return F.sum(F.when(some, sum((F.coalesce(v, F.lit(0.0)) for v in values), F.lit(0.0))))

    wide = df.groupBy(*keys).agg(*[of_year(columns).alias(str(y)) for y, columns in sorted(months.items())])
    long = wide.unpivot(list(keys), [str(y) for y in sorted(months)], year, total)
    long = long.fillna(0.0, [total]) if keep_empty else long.filter(F.col(total).isNotNull())
    return long.withColumn(year, F.col(year).cast("int"))


def unit_year_grid(units: DataFrame, unit: Sequence[str], year: str, first: Column | int, last: Column | int) -> DataFrame:
    """Every unit × every year, by exploding the year range of each unit (no join needed)."""
    years = F.sequence(F.lit(first), F.lit(last))
    return units.select(*unit).dropna().distinct().select(*unit, F.explode(years).alias(year))


def densify(
    df: DataFrame,
    units: DataFrame,
    unit: Sequence[str],
    year: str,
    first: int,
    last: int,
    fill: Mapping[str, object],
    keep_outside: bool = False,
) -> DataFrame:
    """One row per unit and year of the range, ``fill`` where nothing was observed.

    Rows outside the range survive only with ``keep_outside``; rows with no year never do.
    One join serves both, because a full outer join also returns the unmatched data rows.
    """
    grid = unit_year_grid(units, unit, year, first, last)
    data = df.dropna(subset=[*unit, year])
    keys = [*unit, year]
    return grid.join(data, keys, "full_outer" if keep_outside else "left").na.fill(dict(fill))


def add_baseline(df: DataFrame, unit: Sequence[str], year: str, at: int, values: Mapping[str, object]) -> DataFrame:
    """Append a row for year ``at`` with constant ``values`` to every unit."""
    constants = {year: F.lit(at), **{c: F.lit(v) for c, v in values.items()}}
    return df.unionByName(df.select(*unit).distinct().withColumns(constants))
