"""Consolidated panel and star schema over the test tables.

Eight measures stand in for eight indicator domains: five per unit (nation) and year,
two per region and year, one per year.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from panelspark.functions.text import pad_code, upper_name
from panelspark.operators.lookup import map_values
from panelspark.operators.numbering import surrogate_id
from panelspark.operators.profile import correlations_with
from panelspark.operators.rank import winner
from panelspark.plans.panel import NATION, REGION, UNIT, Measure, build_panel
from panelspark.plans.star import Dimension, analysis_set, build_fact, conform
from panelspark.queries.base import WINNERS, line_facts, mean_price, nations, order_facts, total_price
from panelspark.queries.registry import query
from panelspark.queries.winners import LABEL_IDS, SEGMENT_LABELS
from panelspark.tables import settle, settle_all

FIRST, LAST = 1995, 2001
# The units reported on (all but 00 and 20) and the years that have a label.
UNITS = [f"{i:02d}" for i in range(1, 25) if i != 20]
LABELLED_YEARS = [1996, 1998, 2000]


def unit_regions(spark: SparkSession, sf: str) -> DataFrame:
    return nations(spark, sf).select(_code("unit").alias("unit"), F.col("region_id").alias("region"))


def _code(column: str):
    return pad_code(F.col(column).cast("string"))


@dataclass(frozen=True)
class Domains:
    """The eight sources, derived from two tables that are computed once and settled."""

    orders: DataFrame
    lines: DataFrame
    places: DataFrame

    @classmethod
    def of(cls, spark: SparkSession, sf: str) -> Domains:
        facts = settle_all({"orders": order_facts(spark, sf), "lines": line_facts(spark, sf)})
        return cls(facts["orders"], facts["lines"], nations(spark, sf).select("unit", "region_id"))

    def politics(self):
        won = winner(self.orders, ["year", "unit"], "candidate", "cents", "total")
        label = map_values(map_values(upper_name("candidate"), SEGMENT_LABELS), LABEL_IDS)
        won = won.filter(F.col("year").isin(LABELLED_YEARS))
        return won.select("year", _code("unit").alias("unit"), "candidate", label.alias("label"))

    def security(self):
        rows = self.lines.filter("n_returned > 0")
        return rows.select("year", _code("unit").alias("unit"), F.col("n_returned").alias("n"))

    def health(self):
        return self.orders.groupBy("year", _code("unit").alias("unit")).agg(mean_price().alias("value"))

    def economy(self):
        located = self.orders.join(self.places, "unit").groupBy("year", F.col("region_id").alias("region"))
        return located.agg(total_price().alias("value"))

    def environment(self):
        located = self.lines.join(self.places, "unit")
        return located.groupBy("year", F.col("region_id").alias("region")).agg(F.sum("quantity").alias("value"))

    def education(self):
        counted = self.orders.groupBy("year", _code("unit").alias("unit")).agg(F.sum("n_urgent").alias("n"))
        return counted.filter(F.col("n") > 0)

    def demography(self):
        return self.orders.groupBy("year", _code("unit").alias("unit")).agg(F.sum("n_customers").alias("n"))

    def technology(self):
        rate = F.sum("discount_pct") / F.sum("n_lines")
        return self.lines.groupBy("year").agg(rate.alias("value"))


# The same eight measures in SQL.
DOMAINS = WINNERS + """,
  pol AS (SELECT year, lpad(CAST(unit AS VARCHAR), 2, '0') AS unit, candidate,
      CASE candidate WHEN 'BUILDING' THEN 1 WHEN 'FURNITURE' THEN 2 WHEN 'HOUSEHOLD' THEN 2 WHEN 'MACHINERY' THEN 3
        WHEN 'AUTOMOBILE' THEN 4 END AS label
    FROM winners WHERE year IN (1996, 1998, 2000)),
  sec AS (SELECT year(l_shipdate) AS year, lpad(CAST(s_nationkey AS VARCHAR), 2, '0') AS unit, count(*) AS n
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
    WHERE l_returnflag = 'R' GROUP BY 1, 2),
  sat AS (SELECT year(o_orderdate) AS year, lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS unit,
      sum(CAST(round(o_totalprice * 100) AS BIGINT)) / (100.0 * count(*)) AS value FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2),
  soc AS (SELECT year(o_orderdate) AS year, n_regionkey AS region, round(sum(o_totalprice), 2) AS value
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2),
  env AS (SELECT year(l_shipdate) AS year, n_regionkey AS region, sum(l_quantity) AS value
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
    GROUP BY 1, 2),
  edu AS (SELECT year(o_orderdate) AS year, lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS unit, count(*) AS n
    FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderpriority = '1-URGENT' GROUP BY 1, 2),
  dem AS (SELECT year(o_orderdate) AS year, lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS unit,
      count(DISTINCT o_custkey) AS n FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2),
  tec AS (SELECT year(l_shipdate) AS year, avg(CAST(round(l_discount * 100) AS BIGINT)) AS value FROM lineitem GROUP BY 1),
  units AS (SELECT lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS unit, n_regionkey AS region FROM nation
    WHERE n_nationkey NOT IN (0, 20))"""


@query(
    "panel_consolidated",
    f"""WITH {DOMAINS},
      soc_u AS (SELECT year, unit, value AS socio_economy FROM soc JOIN units USING (region)),
      env_u AS (SELECT year, unit, value AS environment FROM env JOIN units USING (region))
    SELECT concat(year, '_', unit) AS panel_key, label::BIGINT AS politics, security, socio_economy, health, environment,
      education, demography, technology
    FROM (SELECT year, unit, label FROM pol) FULL JOIN (SELECT year, unit, n AS security FROM sec) USING (year, unit)
      FULL JOIN soc_u USING (year, unit)
      FULL JOIN (SELECT year, unit, value AS health FROM sat) USING (year, unit)
      FULL JOIN env_u USING (year, unit)
      LEFT JOIN (SELECT year, unit, n AS education FROM edu) USING (year, unit)
      FULL JOIN (SELECT year, unit, n AS demography FROM dem) USING (year, unit)
      LEFT JOIN (SELECT year, value AS technology FROM tec) USING (year)
    WHERE year BETWEEN 1995 AND 2001 AND unit IN (SELECT unit FROM units)""",
)
def panel_consolidated(spark, sf):
    d = Domains.of(spark, sf)
    measures = [
        Measure("politics", d.politics(), "label"),
        Measure("security", d.security(), "n"),
        Measure("socio_economy", d.economy(), "value", REGION),
        Measure("health", d.health(), "value"),
        Measure("environment", d.environment(), "value", REGION),
        Measure("education", d.education(), "n", optional=True),
        Measure("demography", d.demography(), "n"),
        Measure("technology", d.technology(), "value", NATION),
    ]
    panel = build_panel(measures, unit_regions(spark, sf), FIRST, LAST, UNITS).drop("year", "unit")
    return panel.withColumn("politics", F.col("politics").cast("bigint")).orderBy("panel_key")


DIM_POLITICS = StructType(
    [
        StructField("id", LongType()),
        StructField("party_label", LongType()),
        StructField("year", IntegerType()),
        StructField("unit", StringType()),
        StructField("candidate", StringType()),
    ]
)
DIM_COUNT = StructType(
    [
        StructField("id", LongType()),
        StructField("year", IntegerType()),
        StructField("unit", StringType()),
        StructField("n_total", LongType()),
    ]
)
DIM_UNIT_VALUE = StructType(
    [
        StructField("id", LongType()),
        StructField("year", IntegerType()),
        StructField("unit", StringType()),
        StructField("amount", DoubleType()),
    ]
)
DIM_REGION_VALUE = StructType(
    [
        StructField("id", LongType()),
        StructField("year", IntegerType()),
        StructField("region", LongType()),
        StructField("amount", DoubleType()),
    ]
)
DIM_YEAR_VALUE = StructType(
    [StructField("id", LongType()), StructField("year", IntegerType()), StructField("amount", DoubleType())]
)


def dimensions(spark: SparkSession, sf: str) -> list[Dimension]:
    """The eight conformed dimensions with their ids and the attributes that models use."""
    d = Domains.of(spark, sf)

    count, amount = {"n": "N_Total"}, {"value": "amount"}
    # Name, source, mapping, target schema, level, attribute used by models.
    specs = [
        ("politics", d.politics(), {"label": "party_label"}, DIM_POLITICS, UNIT, "party_label"),
        ("security", d.security(), count, DIM_COUNT, UNIT, "n_total"),
        ("socio_economy", d.economy(), amount, DIM_REGION_VALUE, REGION, "amount"),
        ("health", d.health(), amount, DIM_UNIT_VALUE, UNIT, "amount"),
        ("environment", d.environment(), amount, DIM_REGION_VALUE, REGION, "amount"),
        ("education", d.education(), count, DIM_COUNT, UNIT, "n_total"),
        ("demography", d.demography(), count, DIM_COUNT, UNIT, "n_total"),
        ("technology", d.technology(), amount, DIM_YEAR_VALUE, NATION, "amount"),
    ]
    rest = {UNIT: ["unit"], REGION: ["region"], NATION: ["year"]}
    numbered = {
        name: surrogate_id(conform(source, mapping, target), "year", rest[level])
        for name, source, mapping, target, level, _ in specs
    }
    tables = settle_all(numbered)
    return [Dimension(name, tables[name], level, attributes={used: name}) for name, _, _, _, level, used in specs]


def units_reported(spark: SparkSession, sf: str) -> DataFrame:
    return unit_regions(spark, sf).filter(F.col("unit").isin(UNITS))


DIMS = DOMAINS + """,
  d_pol AS (SELECT *, row_number() OVER (ORDER BY year, md5(unit), unit) AS id FROM pol),
  d_sec AS (SELECT *, row_number() OVER (ORDER BY year, md5(unit), unit) AS id FROM sec),
  d_sat AS (SELECT *, row_number() OVER (ORDER BY year, md5(unit), unit) AS id FROM sat),
  d_soc AS (SELECT *, row_number() OVER (ORDER BY year, md5(CAST(region AS VARCHAR)), region) AS id FROM soc),
  d_env AS (SELECT *, row_number() OVER (ORDER BY year, md5(CAST(region AS VARCHAR)), region) AS id FROM env),
  d_edu AS (SELECT *, row_number() OVER (ORDER BY year, md5(unit), unit) AS id FROM edu),
  d_dem AS (SELECT *, row_number() OVER (ORDER BY year, md5(unit), unit) AS id FROM dem),
  d_tec AS (SELECT *, row_number() OVER (ORDER BY year) AS id FROM tec)"""

FACT = DIMS + """,
  fact AS (
    SELECT concat(y.year, '_', u.unit) AS panel_key, d_pol.id AS politics_id, d_sec.id AS security_id,
      d_soc.id AS socio_economy_id, d_sat.id AS health_id, d_env.id AS environment_id, d_edu.id AS education_id,
      d_dem.id AS demography_id, d_tec.id AS technology_id
    FROM units u CROSS JOIN range(1995, 2002) y(year)
      LEFT JOIN d_pol ON d_pol.year = y.year AND d_pol.unit = u.unit
      LEFT JOIN d_sec ON d_sec.year = y.year AND d_sec.unit = u.unit
      LEFT JOIN d_soc ON d_soc.year = y.year AND d_soc.region = u.region
      LEFT JOIN d_sat ON d_sat.year = y.year AND d_sat.unit = u.unit
      LEFT JOIN d_env ON d_env.year = y.year AND d_env.region = u.region
      LEFT JOIN d_edu ON d_edu.year = y.year AND d_edu.unit = u.unit
      LEFT JOIN d_dem ON d_dem.year = y.year AND d_dem.unit = u.unit
      LEFT JOIN d_tec ON d_tec.year = y.year
    WHERE coalesce(d_pol.id, d_sec.id, d_soc.id, d_sat.id, d_env.id, d_edu.id, d_dem.id, d_tec.id) IS NOT NULL)"""

_ATTRIBUTES = """d_sec.n AS security, d_soc.value AS socio_economy, d_sat.value AS health, d_env.value AS environment,
      d_edu.n AS education, d_dem.n AS demography, d_tec.value AS technology, panel_key"""
_DIM_JOINS = """JOIN d_sec ON security_id = d_sec.id JOIN d_soc ON socio_economy_id = d_soc.id
      JOIN d_sat ON health_id = d_sat.id JOIN d_env ON environment_id = d_env.id JOIN d_edu ON education_id = d_edu.id
      JOIN d_dem ON demography_id = d_dem.id JOIN d_tec ON technology_id = d_tec.id"""


@query(
    "star_dim_conform",
    f"WITH {DIMS} SELECT id, year, unit, candidate, label::BIGINT AS party_label FROM d_pol",
)
def star_dim_conform(spark, sf):
    rows = conform(Domains.of(spark, sf).politics(), {"label": "PARTY_LABEL", "candidate": "Candidate"}, DIM_POLITICS)
    numbered = surrogate_id(rows, "year", ["unit"])
    return numbered.select(
        "id", F.col("year").cast("bigint"), "unit", "candidate", F.col("party_label").cast("bigint")
    )


@query("star_fact", f"WITH {FACT} SELECT * FROM fact")
def star_fact(spark, sf):
    return build_fact(dimensions(spark, sf), units_reported(spark, sf), FIRST, LAST)


def analysis_sets(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """(labelled rows, unlabelled rows) over one set of dimensions and one fact table."""
    dims = dimensions(spark, sf)
    fact = settle(build_fact(dims, units_reported(spark, sf), FIRST, LAST), "fact")
    return tuple(
        analysis_set(fact, dims, dims[0], labelled).withColumn("politics", F.col("politics").cast("bigint"))
        for labelled in (True, False)
    )


@query(
    "star_labeled",
    f"""WITH {FACT} SELECT d_pol.label::BIGINT AS politics, {_ATTRIBUTES}
    FROM fact JOIN d_pol ON politics_id = d_pol.id {_DIM_JOINS}""",
)
def star_labeled(spark, sf):
    return analysis_sets(spark, sf)[0]


@query(
    "star_unlabeled",
    f"""WITH {FACT} SELECT NULL::BIGINT AS politics, {_ATTRIBUTES} FROM fact {_DIM_JOINS} WHERE politics_id IS NULL""",
)
def star_unlabeled(spark, sf):
    return analysis_sets(spark, sf)[1]


INDICATORS = ["security", "socio_economy", "health", "environment", "education", "demography", "technology"]


@query(
    "corr_indicator_label",
    f"""WITH {FACT}, x AS (SELECT d_pol.label::DOUBLE AS politics, {_ATTRIBUTES}
      FROM fact JOIN d_pol ON politics_id = d_pol.id {_DIM_JOINS})
    """
    + "\nUNION ALL ".join(f"SELECT '{c}' AS \"column\", round(corr({c}, politics), 6) AS corr FROM x" for c in INDICATORS),
)
def corr_indicator_label(spark, sf):
    """Which indicators go with the winning class, over the labelled unit-years."""
    return correlations_with(analysis_sets(spark, sf)[0], "politics", INDICATORS)
