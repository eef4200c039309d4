"""Star schema: conformed dimensions, the fact of ids, and the analysis sets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, NumericType, StructType

from panelspark.functions.text import panel_key
from panelspark.operators.lookup import fan_out
from panelspark.operators.reshape import unit_year_grid
from panelspark.plans.panel import NATION, REGION, UNIT


def conform(df: DataFrame, mapping: Mapping[str, str], target: StructType, keep_id: bool = False) -> DataFrame:
    """Rename by ``mapping``, keep the columns that ``target`` has (names compared without
    case), give them its names, order and types, and leave its ``id`` to be generated unless ``keep_id``.

    Text that is no number becomes NULL; a number that is too large for the target type is an error, never a silent NULL.
    """
    renamed = {mapping.get(c, c).lower(): c for c in df.columns}
    kept = [f for f in target.fields if f.name.lower() in renamed and (keep_id or f.name.lower() != "id")]
    if not kept:
        raise ValueError(f"no column of {df.columns} belongs to the target {target.names}")
    kinds = {f.name: f.dataType for f in df.schema.fields}

    def fitted(name: str, kind: DataType) -> Column:
        value = F.col(f"`{name}`")
        if not isinstance(kinds[name], NumericType):
            return value.try_cast(kind)
        lost = value.isNotNull() & ~F.isnan(value.cast("double")) & value.try_cast(kind).isNull()
        return F.when(lost, F.raise_error(F.concat(F.lit(f"{name} does not fit {kind.simpleString()}: "), value.cast("string"))).cast(kind)).otherwise(value.try_cast(kind))

    return df.select(*[fitted(renamed[f.name.lower()], f.dataType).alias(f.name) for f in kept])


@dataclass(frozen=True)
class Dimension:
    """A dimension table with its id, keyed like a panel measure by ``level``."""

    name: str
    df: DataFrame
    level: str = UNIT
    id: str = "id"
    attributes: Mapping[str, str] = field(default_factory=dict)

    @property
    def fact_column(self) -> str:
        return f"{self.name}_id"


def build_fact(dimensions: Sequence[Dimension], units: DataFrame, first: int, last: int) -> DataFrame:
    """One row per unit and year with the (nullable) id of every dimension.

    ``units`` lists (unit, region).  Each dimension offers its smallest id per key; cells
    without any id are dropped.  All keyed dimensions go through one union and one aggregate
    instead of a lookup per cell and dimension.
    """
    columns = [d.fact_column for d in dimensions if d.level != NATION]
    parts = [unit_year_grid(units, ["unit"], "year", first, last).withColumn("_cell", F.lit(1))]
    for d in dimensions:
        if d.level == NATION:
            continue
        keys = ["region", "year"] if d.level == REGION else ["unit", "year"]
        in_range = d.df.filter(F.col("year").between(first, last))
        ids = in_range.groupBy(*keys).agg(F.min(d.id).alias(d.fact_column))
        keyed = fan_out(ids, units.select("unit", "region"), "region") if d.level == REGION else ids
        parts.append(keyed.select("unit", "year", d.fact_column))
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part, allowMissingColumns=True)
    fact = stacked.groupBy("year", "unit").agg(F.max("_cell").alias("_cell"), *[F.min(c).alias(c) for c in columns])
    fact = fact.filter(F.col("_cell").isNotNull()).drop("_cell")
    for d in dimensions:
        if d.level == NATION:
            # At most last - first + 1 rows by construction, so the broadcast has a proven bound.
            in_range = d.df.filter(F.col("year").between(first, last))
            yearly = F.broadcast(in_range.groupBy("year").agg(F.min(d.id).alias(d.fact_column)))
            fact = fact.join(yearly, "year", "left")
    all_ids = [d.fact_column for d in dimensions]
    fact = fact.filter(F.coalesce(*all_ids).isNotNull())
    return fact.select(panel_key("year", "unit").alias("panel_key"), *all_ids)


def analysis_set(fact: DataFrame, dimensions: Sequence[Dimension], label: Dimension, labelled: bool) -> DataFrame:
    """Facts joined to their dimensions' attributes.

    ``labelled`` keeps rows that have a label id and adds its attributes; otherwise the rows
    without one, with NULL in the label's place.  The joins are inner: a fact that lacks any
    dimension is left out.
    """
    has_label = F.col(label.fact_column).isNotNull()
    rows = fact.filter(has_label if labelled else ~has_label)
    out: list[str] = []
    for d in dimensions:
        if d.name == label.name and not labelled:
            kinds = dict(d.df.dtypes)
            rows = rows.withColumns({alias: F.lit(None).cast(kinds[c]) for c, alias in d.attributes.items()})
        else:
            looked_up = d.df.select(
                F.col(d.id).alias(d.fact_column), *[F.col(c).alias(alias) for c, alias in d.attributes.items()]
            )
            rows = rows.join(looked_up, d.fact_column)
        out.extend(d.attributes.values())
    return rows.select("panel_key", *out)
