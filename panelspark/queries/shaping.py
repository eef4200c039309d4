"""Reshaping, dense grids and gap filling."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelspark.functions.numbers import mean_of_two
from panelspark.operators.impute import ols_fill
from panelspark.operators.reshape import add_baseline, densify, month_columns_to_years, to_long, to_wide
from panelspark.queries.base import FIRST_YEAR, LAST_YEAR, SERIES, big, customer_orders, mean_price, total_price, unit_year_average
from panelspark.queries.registry import query
from panelspark.tables import table

YEARS = [str(y) for y in range(FIRST_YEAR, LAST_YEAR + 1)]


@query(
    "unpivot_years",
    """WITH g AS (SELECT u.unit, y.year FROM (SELECT DISTINCT c_nationkey AS unit FROM customer) u, range(1995, 2002) y(year)),
      v AS (SELECT c_nationkey AS unit, year(o_orderdate) AS year, round(sum(o_totalprice), 2) AS value
        FROM orders JOIN customer ON o_custkey = c_custkey
        WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'P' AND c_mktsegment = 'BUILDING' GROUP BY 1, 2)
    SELECT g.unit::BIGINT AS unit, g.year, v.value FROM g LEFT JOIN v ON g.unit = v.unit AND g.year = v.year
    WHERE g.unit IN (SELECT unit FROM v)""",
)
def unpivot_years(spark, sf):
    """Wide table with a column per year, then back to one row per (unit, year) with its gaps."""
    rows = customer_orders(spark, sf, where=_is_urgent()).filter(F.col("candidate") == "BUILDING")
    labelled = rows.withColumn("year", F.col("year").cast("string"))
    wide = to_wide(labelled, ["unit"], "year", YEARS, total_price())
    long = to_long(wide, ["unit"], YEARS, "year", "value")
    return long.select(big("unit"), big("year"), "value")


@query(
    "unpivot_month_year",
    """SELECT s_nationkey::BIGINT AS unit, year(l_shipdate) AS year, sum(l_quantity) AS total
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2""",
)
def unpivot_month_year(spark, sf):
    """One column per month (``_YYYY_MM``), several rows per unit, summed to years."""
    lines = table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("s_suppkey"), F.date_format("l_shipdate", "'_'yyyy'_'MM").alias("month"), "l_quantity"
    )
    span = table(spark, sf, "lineitem").agg(F.min(F.year("l_shipdate")).alias("a"), F.max(F.year("l_shipdate")).alias("b"))
    first, last = span.first()
    months = [f"_{y}_{m:02d}" for y in range(first, last + 1) for m in range(1, 13)]
    sheets = to_wide(lines, ["s_suppkey"], "month", months, F.sum("l_quantity"))
    supplier = table(spark, sf, "supplier").select("s_suppkey", F.col("s_nationkey").alias("unit"))
    return month_columns_to_years(sheets.join(supplier, "s_suppkey"), ["unit"], keep_empty=False).select(big("unit"), big("year"), "total")


@query(
    "pivot_mean",
    """WITH p AS (SELECT c_nationkey AS unit, year(o_orderdate) AS year, c_mktsegment AS segment,
        sum(CASE WHEN o_orderstatus = 'F' THEN CAST(round(o_totalprice * 100) AS BIGINT) END)
          / (100.0 * count(*) FILTER (o_orderstatus = 'F')) AS f,
        sum(CASE WHEN o_orderstatus = 'O' THEN CAST(round(o_totalprice * 100) AS BIGINT) END)
          / (100.0 * count(*) FILTER (o_orderstatus = 'O')) AS o
      FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderpriority = '1-URGENT' GROUP BY 1, 2, 3)
    SELECT unit::BIGINT AS unit, year, segment, f AS avg_f, o AS avg_o,
      round((f + o) / 2, 8) AS mean_value FROM p""",
)
def pivot_mean(spark, sf):
    rows = customer_orders(spark, sf, by=["o_orderstatus"], where=F.col("o_orderpriority") == "1-URGENT")
    wide = to_wide(
        rows.withColumnRenamed("candidate", "segment"),
        ["unit", "year", "segment"],
        "o_orderstatus",
        ["F", "O"],
        mean_price(),
    )
    return wide.select(
        big("unit"),
        big("year"),
        "segment",
        F.col("F").alias("avg_f"),
        F.col("O").alias("avg_o"),
        mean_of_two("F", "O", 8).alias("mean_value"),
    )


def _is_urgent():
    return (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "P")


_URGENT = """c AS (SELECT c_nationkey AS unit, c_mktsegment AS segment, year(o_orderdate) AS year, count(*) AS n_urgent,
      round(sum(o_totalprice), 2) AS value FROM orders JOIN customer ON o_custkey = c_custkey
      WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'P' GROUP BY 1, 2, 3),
    u AS (SELECT DISTINCT c_nationkey AS unit, c_mktsegment AS segment FROM customer)"""


def _urgent(spark, sf):
    rows = customer_orders(spark, sf, where=_is_urgent())
    counted = rows.groupBy("unit", F.col("candidate").alias("segment"), "year").agg(
        F.sum("n").alias("n_urgent"), total_price().alias("value")
    )
    customer = table(spark, sf, "customer")
    units = customer.select(F.col("c_nationkey").alias("unit"), F.col("c_mktsegment").alias("segment"))
    return counted, units


@query(
    "densify_zero",
    f"""WITH {_URGENT}
    SELECT u.unit::BIGINT AS unit, u.segment, y.year, coalesce(n_urgent, 0) AS n_urgent, coalesce(value, 0.0) AS value
    FROM u CROSS JOIN range(1995, 2002) y(year) LEFT JOIN c ON c.unit = u.unit AND c.segment = u.segment AND c.year = y.year""",
)
def densify_zero(spark, sf):
    counted, units = _urgent(spark, sf)
    zeros = {"n_urgent": 0, "value": 0.0}
    dense = densify(counted, units, ["unit", "segment"], "year", FIRST_YEAR, LAST_YEAR, zeros)
    return dense.select(big("unit"), "segment", big("year"), "n_urgent", "value")


@query(
    "densify_keep_outside",
    f"""WITH {_URGENT}
    SELECT u.unit::BIGINT AS unit, u.segment, y.year, coalesce(n_urgent, 0) AS n_urgent, coalesce(value, 0.0) AS value
    FROM u CROSS JOIN range(1996, 2001) y(year) LEFT JOIN c ON c.unit = u.unit AND c.segment = u.segment AND c.year = y.year
    UNION ALL SELECT unit, segment, year, n_urgent, value FROM c WHERE year NOT BETWEEN 1996 AND 2000""",
)
def densify_keep_outside(spark, sf):
    """Grid of 1996–2000 only; observed rows of other years stay as they are."""
    counted, units = _urgent(spark, sf)
    zeros = {"n_urgent": 0, "value": 0.0}
    dense = densify(counted, units, ["unit", "segment"], "year", 1996, 2000, zeros, keep_outside=True)
    return dense.select(big("unit"), "segment", big("year"), "n_urgent", "value")


@query(
    "impute_baseline",
    """WITH v AS (SELECT c_nationkey AS unit, year(o_orderdate) AS year, round(sum(o_totalprice), 2) AS value
      FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)
    SELECT unit::BIGINT AS unit, year, value FROM v
    UNION ALL SELECT DISTINCT unit::BIGINT, 1994, 0.0::DOUBLE FROM v""",
)
def impute_baseline(spark, sf):
    sums = customer_orders(spark, sf).groupBy("unit", "year").agg(total_price().alias("value"))
    return add_baseline(sums, ["unit"], "year", 1994, {"value": 0.0}).select(big("unit"), big("year"), "value")


_FILLED = f"""WITH {SERIES},
    hidden AS (SELECT unit, year, CASE WHEN unit % 5 = 1 AND year < 1998 THEN NULL
        WHEN unit = 9 AND year <> 1996 THEN NULL ELSE value END AS value FROM series),
    line AS (SELECT unit, regr_slope(value, year - 1995) AS b, avg(value) AS my, avg(year - 1995) AS mx, count(*) AS n
      FROM hidden WHERE value IS NOT NULL GROUP BY 1),
    f AS (SELECT h.unit, h.year, h.value, CASE WHEN n >= 2 THEN my + b * (h.year - 1995 - mx) END AS predicted
      FROM hidden h LEFT JOIN line USING (unit))"""


def _hidden(spark, sf):
    """The series with gaps: some units lose their early years, unit 9 keeps one year only."""
    gap = ((F.col("unit") % 5 == 1) & (F.col("year") < 1998)) | ((F.col("unit") == 9) & (F.col("year") != 1996))
    return unit_year_average(spark, sf).withColumn("value", F.when(~gap, F.col("value")))


@query(
    "impute_ols_trunc",
    f"""{_FILLED} SELECT unit::BIGINT AS unit, year, value IS NULL AS filled,
      CASE WHEN value IS NULL THEN trunc(predicted) ELSE value END AS value FROM f""",
)
def impute_ols_trunc(spark, sf):
    gaps = _hidden(spark, sf).withColumn("filled", F.col("value").isNull())
    full = ols_fill(gaps, ["unit"], "year", "value", post="trunc")
    return full.select(big("unit"), big("year"), "filled", "value")


@query(
    "impute_ols_round",
    f"""{_FILLED} SELECT unit::BIGINT AS unit, year, value IS NULL AS filled,
      round(coalesce(value, predicted), 2) AS value FROM f""",
)
def impute_ols_round(spark, sf):
    gaps = _hidden(spark, sf).withColumn("filled", F.col("value").isNull())
    full = ols_fill(gaps, ["unit"], "year", "value", post="round")
    return full.select(big("unit"), big("year"), "filled", "value")
