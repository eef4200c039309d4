"""Aggregates, winners and majorities."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.functions.numbers import flag, percent_of
from panelspark.operators.lookup import map_values
from panelspark.operators.rank import distribution, majority, top_per_group, total_by, winner
from panelspark.queries.base import WINNERS, big, customer_orders, hundredths, nations, regions
from panelspark.queries.registry import query
from panelspark.tables import table

# Label and class number of every market segment, in the role of party and orientation.
SEGMENT_LABELS = {
    "AUTOMOBILE": "Transport",
    "BUILDING": "Construction",
    "FURNITURE": "Home",
    "HOUSEHOLD": "Home",
    "MACHINERY": "Industry",
}
LABEL_IDS = {"Construction": 1, "Home": 2, "Industry": 3, "Transport": 4}


def votes_won(spark: SparkSession, sf: str) -> DataFrame:
    """(year, unit, candidate, total) of the winning segment."""
    won = winner(customer_orders(spark, sf), ["year", "unit"], "candidate", "cents", "total")
    return won.withColumn("total", F.col("total") / 100)


@query(
    "agg_sum",
    """SELECT year(o_orderdate) AS year, c_nationkey::BIGINT AS unit, round(sum(o_totalprice), 2) AS total
    FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2""",
)
def agg_sum(spark, sf):
    sums = total_by(customer_orders(spark, sf), ["year", "unit"], "cents", "total")
    return sums.select(big("year"), big("unit"), (F.col("total") / 100).alias("total"))


@query(
    "agg_share",
    """SELECT year(l_shipdate) AS year, s_nationkey::BIGINT AS unit, min(s_name) AS label,
         count(l_orderkey) AS n_total,
         count(*) FILTER (l_returnflag = 'R') AS n_returned,
         count(*) FILTER (l_returnflag <> 'R') AS n_kept,
         round(100.0 * count(*) FILTER (l_returnflag = 'R') / count(l_orderkey), 4) AS pct_returned,
         round(100.0 * count(*) FILTER (l_returnflag <> 'R') / count(l_orderkey), 4) AS pct_kept
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2""",
)
def agg_share(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        F.year("l_shipdate").alias("year"), F.col("l_suppkey").alias("s_suppkey"), "l_orderkey", "l_returnflag"
    )
    # Lines are counted per supplier first, so a supplier with a third of them is a few rows in the join.
    per_supplier = lines.groupBy("s_suppkey", "year").agg(
        F.count("l_orderkey").alias("n_total"),
        F.sum(flag(F.col("l_returnflag") == "R")).alias("n_returned"),
        F.sum(flag(F.col("l_returnflag") != "R")).alias("n_kept"),
    )
    supplier = table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    grouped = (
        per_supplier.join(supplier, "s_suppkey")
        .groupBy("year", F.col("s_nationkey").alias("unit"))
        .agg(
            F.min("s_name").alias("label"),
            F.sum("n_total").alias("n_total"),
            F.sum("n_returned").alias("n_returned"),
            F.sum("n_kept").alias("n_kept"),
        )
    )
    return grouped.select(
        big("year"),
        big("unit"),
        "label",
        "n_total",
        "n_returned",
        "n_kept",
        percent_of("n_returned", "n_total", 4).alias("pct_returned"),
        percent_of("n_kept", "n_total", 4).alias("pct_kept"),
    )


@query(
    "agg_mean_by_year",
    """SELECT 'quality' AS series, source AS grp, avg(quality) AS mean_value
    FROM labels JOIN documents USING (doc_id) GROUP BY source
    UNION ALL
    SELECT 'order_total', CAST(year(o_orderdate) AS VARCHAR), 
      sum(CAST(round(o_totalprice * 100) AS BIGINT)) / (100.0 * count(*)) FROM orders GROUP BY 2""",
)
def agg_mean_by_year(spark, sf):
    documents = table(spark, sf, "documents").select("doc_id", "source")
    labels = table(spark, sf, "labels").select("doc_id", "quality")
    quality = labels.join(documents, "doc_id").groupBy(F.col("source").alias("grp"))
    price = table(spark, sf, "orders").groupBy(F.year("o_orderdate").cast("string").alias("grp"))
    mean_order = F.sum(hundredths("o_totalprice")) / (F.count(F.lit(1)) * 100)
    parts = [
        quality.agg(F.avg("quality").alias("mean_value")).withColumn("series", F.lit("quality")),
        price.agg(mean_order.alias("mean_value")).withColumn("series", F.lit("order_total")),
    ]
    return parts[0].unionByName(parts[1]).select("series", "grp", "mean_value")


@query(
    "winner_summed",
    f"WITH {WINNERS} SELECT year, unit::BIGINT AS unit, candidate, total FROM winners",
)
def winner_summed(spark, sf):
    return votes_won(spark, sf).select(big("year"), big("unit"), "candidate", "total")


@query(
    "winner_simple",
    """SELECT o_custkey AS customer, o_orderkey AS best_order, o_totalprice AS price FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) = 1""",
)
def winner_simple(spark, sf):
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    best = top_per_group(orders, ["o_custkey"], [F.desc("o_totalprice"), F.asc("o_orderkey")])
    return best.withColumnsRenamed({"o_custkey": "customer", "o_orderkey": "best_order", "o_totalprice": "price"})


@query(
    "majority_class",
    """WITH c AS (SELECT year(o_orderdate) AS year, c_mktsegment AS label, count(*) AS n
      FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)
    SELECT year, label, n, sum(n) OVER (PARTITION BY year)::BIGINT AS n_rows,
      round(n * 100.0 / sum(n) OVER (PARTITION BY year), 4) AS pct
    FROM c QUALIFY row_number() OVER (PARTITION BY year ORDER BY n DESC, label) = 1""",
)
def majority_class(spark, sf):
    rows = customer_orders(spark, sf).select("year", F.col("candidate").alias("label"), "n")
    return majority(rows, "label", ["year"], weight="n").withColumn("year", F.col("year").cast("bigint"))


@query(
    "label_distribution",
    """SELECT o_orderpriority AS label, count(*) AS n, (SELECT count(*) FROM orders) AS n_rows,
      round(count(*) * 100.0 / (SELECT count(*) FROM orders), 4) AS pct FROM orders GROUP BY 1""",
)
def label_distribution(spark, sf):
    return distribution(table(spark, sf, "orders").select(F.col("o_orderpriority").alias("label")), "label")


@query(
    "trend_region_year",
    f"""WITH {WINNERS}, c AS (
      SELECT r_name AS region, year, candidate, count(*) AS n
      FROM winners JOIN nation ON unit = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2, 3)
    SELECT region, year, candidate, n, sum(n) OVER (PARTITION BY region, year)::BIGINT AS n_rows,
      round(n * 100.0 / sum(n) OVER (PARTITION BY region, year), 4) AS pct FROM c""",
)
def trend_region_year(spark, sf):
    located = votes_won(spark, sf).join(nations(spark, sf), "unit").join(regions(spark, sf), "region_id")
    return distribution(located, "candidate", ["region", "year"]).withColumn("year", F.col("year").cast("bigint"))


@query(
    "flagship_winner_panel",
    f"""WITH {WINNERS}
    SELECT concat(year, '_', lpad(CAST(unit AS VARCHAR), 2, '0')) AS panel_key, year, unit::BIGINT AS unit,
      n_name AS unit_name, r_name AS region, candidate, total,
      CASE candidate WHEN 'AUTOMOBILE' THEN 'Transport' WHEN 'BUILDING' THEN 'Construction'
        WHEN 'FURNITURE' THEN 'Home' WHEN 'HOUSEHOLD' THEN 'Home' WHEN 'MACHINERY' THEN 'Industry' END AS label,
      CAST(CASE candidate WHEN 'AUTOMOBILE' THEN 4 WHEN 'BUILDING' THEN 1 WHEN 'FURNITURE' THEN 2
        WHEN 'HOUSEHOLD' THEN 2 WHEN 'MACHINERY' THEN 3 END AS BIGINT) AS label_id
    FROM winners JOIN nation ON unit = n_nationkey JOIN region ON n_regionkey = r_regionkey ORDER BY 1""",
)
def flagship_winner_panel(spark, sf):
    """Sum → winner → label and class → region → ordered panel: the election pipeline end to end."""
    from panelspark.functions.text import pad_code, panel_key, upper_name

    won = votes_won(spark, sf)
    located = won.join(nations(spark, sf), "unit").join(regions(spark, sf), "region_id")
    labelled = located.withColumn("label", map_values(upper_name("candidate"), SEGMENT_LABELS))
    return labelled.select(
        panel_key("year", pad_code(F.col("unit").cast("string"))).alias("panel_key"),
        big("year"),
        big("unit"),
        "unit_name",
        "region",
        "candidate",
        "total",
        "label",
        map_values("label", LABEL_IDS).cast("bigint").alias("label_id"),
    ).orderBy("panel_key")


