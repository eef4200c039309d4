"""Cleaning, parsing and value mapping."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelspark.functions import text
from panelspark.operators.lookup import KEEP, map_from_table, map_values
from panelspark.operators.quality import without_empty_rows
from panelspark.queries.base import big
from panelspark.queries.registry import query
from panelspark.tables import table

# Short names of the order priorities that have one.
PRIORITY_NAMES = {"1-URGENT": "Urgent", "2-HIGH": "High", "5-LOW": "Low"}


@query(
    "clean_text",
    """SELECT doc_id, coalesce(trim(lower(CASE WHEN lang = 'fr' THEN NULL ELSE concat(' ', upper(lang), ' ') END)),
        'non spécifié') AS lang,
      coalesce(trim(lower(source)), 'non spécifié') AS source,
      coalesce(CASE WHEN quality = 1 THEN 'good' END, 'unknown') AS quality
    FROM documents LEFT JOIN labels USING (doc_id)""",
)
def clean_text(spark, sf):
    documents = table(spark, sf, "documents").select("doc_id", "lang", "source")
    dirty = documents.withColumn("lang", F.when(F.col("lang") != "fr", F.concat(F.lit(" "), F.upper("lang"), F.lit(" "))))
    labels = table(spark, sf, "labels").select("doc_id", F.when(F.col("quality") == 1, F.lit("good")).alias("quality"))
    joined = without_empty_rows(dirty).join(labels, "doc_id", "left")
    return joined.select(
        "doc_id",
        text.standard_text("lang").alias("lang"),
        text.standard_text("source").alias("source"),
        F.coalesce("quality", F.lit("unknown")).alias("quality"),
    )


@query(
    "clean_name_key",
    """WITH spelled AS (
      SELECT s_suppkey AS id, concat(' Nâtïon-', CAST(s_nationkey AS VARCHAR), '''  ') AS spelling FROM supplier),
    keyed AS (
      SELECT id, spelling,
        regexp_replace(translate(lower(trim(spelling)), 'éèêëàâäîïôöùûüç', 'eeeeaaaiioouuuc'), '[-'' ]', '', 'g') AS k
      FROM spelled)
    SELECT id, spelling, k AS name_key, n_name AS unit_name, n_nationkey::BIGINT AS unit
    FROM keyed LEFT JOIN nation ON k = replace(lower(n_name), '_', '')""",
)
def clean_name_key(spark, sf):
    """Names with accents, blanks, dashes and quotes still find their nation."""
    spelled = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("id"),
        F.concat(F.lit(" Nâtïon-"), F.col("s_nationkey").cast("string"), F.lit("'  ")).alias("spelling"),
    )
    nation = table(spark, sf, "nation").select(
        text.name_key(F.replace("n_name", F.lit("_"), F.lit(" "))).alias("name_key"),
        F.col("n_name").alias("unit_name"),
        F.col("n_nationkey").cast("bigint").alias("unit"),
    )
    return spelled.withColumn("name_key", text.name_key("spelling")).join(nation, "name_key", "left")


@query(
    "clean_code",
    """WITH raw AS (
      SELECT c_custkey AS id, CASE WHEN c_nationkey = 3 THEN '2A' WHEN c_nationkey = 4 THEN 'n/a'
        ELSE concat('"', CAST(c_custkey AS VARCHAR), '.0"') END AS raw_code FROM customer),
    cleaned AS (
      SELECT id, trim(regexp_replace(replace(trim(raw_code), '"', ''), '\\.0$', '')) AS c FROM raw),
    padded AS (SELECT id, CASE WHEN length(c) < 2 THEN lpad(c, 2, '0') ELSE c END AS code FROM cleaned)
    SELECT id, code, TRY_CAST(code AS BIGINT) AS number,
      regexp_matches(code, '^[0-9]+$') AND coalesce(TRY_CAST(code AS INT) BETWEEN 1 AND 95, false) AS in_range
    FROM padded WHERE regexp_matches(code, '^(2A|2B|[0-9]{1,3})$')""",
)
def clean_code(spark, sf):
    raw = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"),
        F.when(F.col("c_nationkey") == 3, F.lit("2A"))
        .when(F.col("c_nationkey") == 4, F.lit("n/a"))
        .otherwise(F.concat(F.lit('"'), F.col("c_custkey").cast("string"), F.lit('.0"')))
        .alias("raw_code"),
    )
    coded = raw.select("id", text.unit_code("raw_code").alias("code")).filter(text.is_unit_code("code"))
    return coded.select(
        "id",
        "code",
        F.col("code").try_cast("bigint").alias("number"),
        F.coalesce(text.code_in_range("code", 1, 95), F.lit(False)).alias("in_range"),
    )


@query(
    "extract_label_parts",
    """SELECT c_custkey AS id, regexp_extract(c_name, '^([A-Za-z]+)#0*([0-9]+)$', 1) AS prefix,
      TRY_CAST(regexp_extract(c_name, '^([A-Za-z]+)#0*([0-9]+)$', 2) AS BIGINT) AS number
    FROM customer WHERE starts_with(c_name, 'Customer#')""",
)
def extract_label_parts(spark, sf):
    pattern = r"^([A-Za-z]+)#0*([0-9]+)$"
    named = table(spark, sf, "customer").filter(F.col("c_name").startswith("Customer#"))
    return named.select(
        F.col("c_custkey").alias("id"),
        F.regexp_extract("c_name", pattern, 1).alias("prefix"),
        F.regexp_extract("c_name", pattern, 2).try_cast("bigint").alias("number"),
    )


@query(
    "map_case",
    """SELECT o_orderkey AS id,
      CASE o_orderpriority WHEN '1-URGENT' THEN 'Urgent' WHEN '2-HIGH' THEN 'High' WHEN '5-LOW' THEN 'Low'
        ELSE o_orderpriority END AS kept,
      CASE o_orderpriority WHEN '1-URGENT' THEN 'Urgent' WHEN '2-HIGH' THEN 'High' WHEN '5-LOW' THEN 'Low' END AS strict,
      CASE o_orderpriority WHEN '1-URGENT' THEN 'Urgent' WHEN '2-HIGH' THEN 'High' WHEN '5-LOW' THEN 'Low'
        ELSE 'Unknown' END AS named
    FROM orders""",
)
def map_case(spark, sf):
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), text.upper_name("o_orderpriority").alias("p"))
    return orders.select(
        "id",
        map_values("p", PRIORITY_NAMES, KEEP).alias("kept"),
        map_values("p", PRIORITY_NAMES).alias("strict"),
        map_values("p", PRIORITY_NAMES, "Unknown").alias("named"),
    )


@query(
    "map_lookup_join",
    """SELECT s_suppkey AS id, s_nationkey::BIGINT AS unit, n_name AS unit_name
    FROM supplier LEFT JOIN (SELECT * FROM nation WHERE n_nationkey <> 7) ON s_nationkey = n_nationkey""",
)
def map_lookup_join(spark, sf):
    suppliers = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), big("s_nationkey", "unit"))
    names = table(spark, sf, "nation").filter(F.col("n_nationkey") != 7)
    return map_from_table(suppliers, "unit", names, "n_nationkey", "n_name", "unit_name")


@query(
    "predict_year_filter",
    """SELECT concat(year(o_orderdate), '_', lpad(CAST(c_nationkey AS VARCHAR), 2, '0')) AS panel_key,
      year(o_orderdate) AS year, count(*) AS n_orders
    FROM orders JOIN customer ON o_custkey = c_custkey WHERE year(o_orderdate) IN (1996, 1999) GROUP BY 1, 2""",
)
def predict_year_filter(spark, sf):
    from panelspark.ml.predict import keep_chosen_years
    from panelspark.queries.base import customer_orders

    key = text.panel_key("year", text.pad_code(F.col("unit").cast("string")))
    counted = customer_orders(spark, sf).groupBy(key.alias("panel_key")).agg(F.sum("n").alias("n_orders"))
    chosen = keep_chosen_years(counted, "panel_key", [1996, 1999], valid=range(1995, 2002), labelled={1997, 2000})
    return chosen.select("panel_key", text.panel_key_year("panel_key").cast("bigint").alias("year"), "n_orders")
