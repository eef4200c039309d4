"""Joins, semi and anti joins, deduplication, upsert, constraint checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelspark.functions.numbers import deflate
from panelspark.operators.lookup import add_missing_units, fan_out, rows_with_match
from panelspark.operators.quality import duplicate_keys, missing_values, orphan_keys
from panelspark.operators.rank import distinct_rows, upsert_latest
from panelspark.queries.base import big, customer_orders, hundredths, nations, total_price
from panelspark.queries.registry import query
from panelspark.tables import table


@query(
    "derive_real_value",
    """WITH v AS (SELECT year(o_orderdate) AS year, c_nationkey AS unit, round(sum(o_totalprice), 2) AS amount
        FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2),
      r AS (SELECT year(l_shipdate) AS year, round(avg(CAST(round(l_discount * 100) AS BIGINT)), 2) AS rate FROM lineitem
        WHERE year(l_shipdate) <> 1997 GROUP BY 1)
    SELECT year, unit::BIGINT AS unit, amount, rate, round(amount / (1 + rate / 100), 2) AS real_amount
    FROM v LEFT JOIN r USING (year)""",
)
def derive_real_value(spark, sf):
    """Amounts deflated by a national yearly rate; the rate is rounded before it divides."""
    amounts = customer_orders(spark, sf).groupBy("year", "unit").agg(total_price().alias("amount"))
    rates = (
        table(spark, sf, "lineitem")
        .groupBy(F.year("l_shipdate").alias("year"))
        .agg(F.round(F.avg(hundredths("l_discount")), 2).alias("rate"))
        .filter(F.col("year") != 1997)
    )
    joined = amounts.join(rates, "year", "left")
    return joined.select(big("year"), big("unit"), "amount", "rate", deflate("amount", "rate").alias("real_amount"))


@query(
    "join_region_fanout",
    """WITH s AS (SELECT n_regionkey, year(o_orderdate) AS year, round(sum(o_totalprice), 2) AS total
      FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2)
    SELECT n_nationkey::BIGINT AS unit, year, total FROM nation JOIN s USING (n_regionkey)""",
)
def join_region_fanout(spark, sf):
    units = nations(spark, sf).select("unit", "region_id")
    per_unit = customer_orders(spark, sf).groupBy("unit", "year").agg(F.sum("cents").alias("cents"))
    regional = per_unit.join(units, "unit").groupBy("region_id", "year").agg(total_price().alias("total"))
    return fan_out(regional, units, "region_id").select(big("unit"), big("year"), "total")


@query(
    "semi_valid_units",
    """SELECT c_custkey AS id, c_name AS name FROM customer
    WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND year(o_orderdate) = 2001)""",
)
def semi_valid_units(spark, sf):
    customers = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    recent = table(spark, sf, "orders").filter(F.col("o_orderdate") >= F.lit("2001-01-01").cast("timestamp_ntz"))
    recent = recent.filter(F.col("o_orderdate") < F.lit("2002-01-01").cast("timestamp_ntz"))
    return rows_with_match(customers, recent.select(F.col("o_custkey").alias("id")), ["id"])


@query(
    "anti_missing_units",
    """WITH seen AS (SELECT c_custkey AS id, count(*) AS n_orders FROM orders JOIN customer ON o_custkey = c_custkey
        WHERE year(o_orderdate) = 2001 GROUP BY 1)
    SELECT id, 2001::BIGINT AS year, n_orders FROM seen
    UNION ALL SELECT c_custkey, 2001, NULL FROM customer
    WHERE NOT EXISTS (SELECT 1 FROM seen WHERE id = c_custkey)""",
)
def anti_missing_units(spark, sf):
    """Units without a row in the last year get one, with no value."""
    orders = table(spark, sf, "orders").filter(F.year("o_orderdate") == 2001)
    year = F.lit(2001).cast("bigint")
    seen = orders.groupBy(F.col("o_custkey").alias("id")).agg(F.count(F.lit(1)).alias("n_orders")).withColumn("year", year)
    customers = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"))
    return add_missing_units(seen, customers, "id", {"year": year})


@query("dedupe_rows", """SELECT DISTINCT * REPLACE (l_linenumber::BIGINT AS l_linenumber,
    strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS l_shipdate) FROM lineitem""")
def dedupe_rows(spark, sf):
    lines = table(spark, sf, "lineitem").withColumns(
        {"l_linenumber": big("l_linenumber"), "l_shipdate": F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss")}
    )
    return distinct_rows(lines.union(lines))


@query(
    "upsert_latest",
    """WITH base AS (SELECT o_orderkey AS id, o_orderstatus AS status, o_totalprice AS price, 1::BIGINT AS version FROM orders),
      delta AS (SELECT o_orderkey AS id, 'X' AS status, round(o_totalprice * 2, 2) AS price, 2::BIGINT AS version
        FROM orders WHERE o_orderpriority = '1-URGENT'
        UNION ALL SELECT o_orderkey, 'stale', 0.0, 0 FROM orders WHERE o_orderpriority = '2-HIGH'
        UNION ALL SELECT -1 - o_orderkey, 'new', o_totalprice, 1 FROM orders WHERE o_orderpriority = '5-LOW')
    SELECT id, status, price, version FROM (SELECT *, 0 AS f FROM base UNION ALL SELECT *, 1 FROM delta)
    QUALIFY row_number() OVER (PARTITION BY id ORDER BY version DESC, f DESC) = 1""",
)
def upsert_latest_query(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority")

    def shaped(df, key, status, price, version):
        return df.select(
            key.alias("id"), status.alias("status"), price.alias("price"), F.lit(version).cast("bigint").alias("version")
        )

    key, price, priority = F.col("o_orderkey"), F.col("o_totalprice"), F.col("o_orderpriority")
    base = shaped(orders, key, F.col("o_orderstatus"), price, 1)
    changed = shaped(orders.filter(priority == "1-URGENT"), key, F.lit("X"), F.round(price * 2, 2), 2)
    stale = shaped(orders.filter(priority == "2-HIGH"), key, F.lit("stale"), F.lit(0.0), 0)
    new = shaped(orders.filter(priority == "5-LOW"), -1 - key, F.lit("new"), price, 1)
    return upsert_latest(base, changed.unionByName(stale).unionByName(new), ["id"], "version", ["status", "price"])


@query(
    "check_keys",
    """SELECT l_orderkey AS order_id, l_linenumber::BIGINT AS line, count(*) AS n_rows
    FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""",
)
def check_keys(spark, sf):
    lines = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("order_id"), big("l_linenumber", "line"))
    return duplicate_keys(lines, ["order_id", "line"])


@query(
    "check_orphans",
    """SELECT l_partkey AS part_id, count(*) AS n_rows FROM lineitem
    WHERE NOT EXISTS (SELECT 1 FROM part WHERE p_partkey = l_partkey AND p_size > 10) GROUP BY 1""",
)
def check_orphans(spark, sf):
    lines = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("part_id"))
    return orphan_keys(lines, "part_id", table(spark, sf, "part").filter(F.col("p_size") > 10), "p_partkey")


@query(
    "check_missing",
    """WITH j AS (SELECT doc_id, source, quality, toxic FROM documents LEFT JOIN labels USING (doc_id))
    SELECT 'source' AS "column", count(*) FILTER (source IS NULL) AS n_missing FROM j
    UNION ALL SELECT 'quality', count(*) FILTER (quality IS NULL) FROM j
    UNION ALL SELECT 'toxic', count(*) FILTER (toxic IS NULL) FROM j""",
)
def check_missing(spark, sf):
    documents = table(spark, sf, "documents").select("doc_id", "source")
    joined = documents.join(table(spark, sf, "labels"), "doc_id", "left")
    return missing_values(joined, ["source", "quality", "toxic"])
