"""Consolidated panel: many measures, one row per unit and year."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.functions.text import panel_key
from panelspark.operators.lookup import fan_out

UNIT, REGION, NATION = "unit", "region", "nation"


@dataclass(frozen=True)
class Measure:
    """One input of the panel.

    ``level`` says whether ``df`` is keyed by (year, unit), (year, region) or year alone.
    An ``optional`` measure only decorates keys that an earlier measure brings in.
    """

    name: str
    df: DataFrame
    value: str
    level: str = UNIT
    optional: bool = False


def _one_row_per_key(m: Measure, keys: Sequence[str], first: int, last: int) -> DataFrame:
    in_range = m.df.filter(F.col("year").between(first, last))
    return in_range.groupBy(*keys).agg(F.min(m.value).alias(m.name))


def build_panel(
    measures: Sequence[Measure], units: DataFrame, first: int, last: int, codes: Sequence[str] | None = None
) -> DataFrame:
    """(panel_key, year, unit, one column per measure) for the years and units asked for.

    The result equals a chain of full outer joins on (year, unit) — left joins for optional
    and national measures — but is planned as one union and one grouped aggregate: a chain
    loses its partitioning at every step, while this shuffles each pre-aggregated input once.
    Year and unit filters are applied to every input, since they do not move below a full join.
    """
    wanted = units if codes is None else units.filter(F.col("unit").isin(list(codes)))
    parts: list[DataFrame] = []
    for position, m in enumerate(measures):
        if m.level == NATION:
            continue
        if m.level == REGION:
            keyed = fan_out(_one_row_per_key(m, ["region", "year"], first, last), wanted, "region")
        else:
            source = m.df if codes is None else m.df.filter(F.col("unit").isin(list(codes)))
            keyed = _one_row_per_key(Measure(m.name, source, m.value), ["year", "unit"], first, last)
        brings_key = F.lit(None if m.optional else position).cast("int")
        parts.append(keyed.select("year", "unit", m.name, brings_key.alias("_since")))
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part, allowMissingColumns=True)

    columns = [m.name for m in measures if m.level != NATION]
    grouped = stacked.groupBy("year", "unit").agg(
        F.min("_since").alias("_since"), *[F.min(c).alias(c) for c in columns]
    )
    panel = grouped.filter(F.col("_since").isNotNull())
    for position, m in enumerate(measures):
        if m.optional and m.level != NATION:
            panel = panel.withColumn(m.name, F.when(F.col("_since") < position, F.col(m.name)))
    if codes is None:
        panel = panel.join(wanted.select("unit").distinct(), "unit", "left_semi")
    for m in measures:
        if m.level == NATION:
            # At most last - first + 1 rows by construction, so the broadcast has a proven bound.
            yearly = F.broadcast(_one_row_per_key(m, ["year"], first, last))
            panel = panel.join(yearly, "year", "left")
    return panel.select(panel_key("year", "unit").alias("panel_key"), "year", "unit", *[m.name for m in measures])
