"""Shared inputs: the test tables read as a panel (unit = nation, candidate = market segment)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.tables import table

FIRST_YEAR, LAST_YEAR = 1995, 2001


def big(column: str, alias: str | None = None):
    """Integer output column in the type both engines agree on."""
    return F.col(column).cast("bigint").alias(alias or column)


def hundredths(column: str) -> Column:
    """Two-decimal amount as a whole number of hundredths.

    Whole numbers add up to the same total in any order, so results do not depend on how
    rows are spread over tasks, and a retried task cannot flip a near tie.
    """
    return F.round(F.col(column) * 100).cast("bigint")


def customer_orders(
    spark: SparkSession, sf: str, by: Sequence[str] = (), where: Column | None = None
) -> DataFrame:
    """Order totals per customer and year (and ``by``), with the customer's unit and candidate.

    Columns: year, unit, candidate, *by, cents (price sum), n (orders), n_urgent.  Orders are summed per
    customer before they meet the customer table, so a customer with a third of all orders
    enters the join as a handful of rows.
    """
    orders = table(spark, sf, "orders")
    orders = orders if where is None else orders.filter(where)
    sums = orders.groupBy("o_custkey", F.year("o_orderdate").alias("year"), *by).agg(
        F.sum(hundredths("o_totalprice")).alias("cents"),
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("n_urgent"),
    )
    customer = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("unit"), F.col("c_mktsegment").alias("candidate")
    )
    return sums.join(customer, "o_custkey").drop("o_custkey")


def total_price() -> Column:
    return F.sum("cents") / 100


def mean_price() -> Column:
    return F.sum("cents") / (F.sum("n") * 100)


def order_facts(spark: SparkSession, sf: str) -> DataFrame:
    """(year, unit, candidate) → cents, n, n_urgent, n_customers."""
    return customer_orders(spark, sf).groupBy("year", "unit", "candidate").agg(
        F.sum("cents").alias("cents"),
        F.sum("n").alias("n"),
        F.sum("n_urgent").alias("n_urgent"),
        # The input has one row per customer and year, so rows are distinct customers.
        F.count(F.lit(1)).alias("n_customers"),
    )


def line_facts(spark: SparkSession, sf: str) -> DataFrame:
    """(year, unit) → n_lines, n_returned, quantity, discount_pct; lines are summed per supplier first."""
    lines = table(spark, sf, "lineitem").groupBy(
        F.col("l_suppkey").alias("s_suppkey"), F.year("l_shipdate").alias("year")
    )
    per_supplier = lines.agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.count_if(F.col("l_returnflag") == "R").alias("n_returned"),
        F.sum("l_quantity").alias("quantity"),
        F.sum(hundredths("l_discount")).alias("discount_pct"),
    )
    supplier = table(spark, sf, "supplier").select("s_suppkey", F.col("s_nationkey").alias("unit"))
    sums = [F.sum(c).alias(c) for c in ("n_lines", "n_returned", "quantity", "discount_pct")]
    return per_supplier.join(supplier, "s_suppkey").groupBy("year", "unit").agg(*sums)


def nations(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "nation").select(
        F.col("n_nationkey").alias("unit"), F.col("n_name").alias("unit_name"), F.col("n_regionkey").alias("region_id")
    )


def regions(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "region").select(F.col("r_regionkey").alias("region_id"), F.col("r_name").alias("region"))


def unit_year_average(spark: SparkSession, sf: str) -> DataFrame:
    """Un-rounded average order price by unit and year."""
    return order_facts(spark, sf).groupBy("unit", "year").agg(mean_price().alias("value"))


# The same inputs in SQL.
VOTES = """votes AS (
  SELECT year(o_orderdate) AS year, c_nationkey AS unit, c_mktsegment AS candidate,
         round(sum(o_totalprice), 2) AS total
  FROM orders JOIN customer ON o_custkey = c_custkey
  GROUP BY 1, 2, 3)"""

WINNERS = VOTES + """, winners AS (
  SELECT year, unit, candidate, total FROM (
    SELECT *, row_number() OVER (PARTITION BY year, unit ORDER BY total DESC, candidate) AS rn FROM votes)
  WHERE rn = 1)"""

SERIES = """series AS (
  SELECT c_nationkey AS unit, year(o_orderdate) AS year,
      sum(CAST(round(o_totalprice * 100) AS BIGINT)) / (100.0 * count(*)) AS value
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)"""
