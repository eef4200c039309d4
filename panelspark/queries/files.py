"""File sources and sinks: data of the test tables is written out in a dialect and read back."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from panelspark.functions.text import year_in_path
from panelspark.queries.base import big, customer_orders
from panelspark.queries.registry import query
from panelspark.sinks.writers import append_table, create_table, processed_path, write_csv
from panelspark.sources.delimited import (
    read_any,
    read_by_header,
    read_delimited,
    read_headerless,
    read_tagged,
    sanitise_columns,
    skip_preamble,
    stack,
)
from panelspark.tables import shared_dir, table


@query(
    "src_csv_roundtrip",
    """SELECT c_custkey AS Code_client, c_name AS Nom_du_client, c_acctbal AS Solde_EUR,
      c_mktsegment AS Marché_visé FROM customer""",
)
def src_csv_roundtrip(spark, sf):
    """Odd headers and ``;``: written, sniffed, read with a schema, made identifier-safe."""
    customers = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    odd = customers.toDF(" Code client", "Nom du client", "Solde (EUR)", "Marché visé")
    path = write_csv(odd, processed_path(shared_dir(spark, "csv"), "raw/customers.csv"))
    schema = StructType(
        [
            StructField(" Code client", LongType()),
            StructField("Nom du client", StringType()),
            StructField("Solde (EUR)", DoubleType()),
            StructField("Marché visé", StringType()),
        ]
    )
    return sanitise_columns(read_any(spark, path, schema))


@query(
    "src_headerless",
    "SELECT lpad(CAST(o_custkey AS VARCHAR), 12, '0') AS code, o_orderkey AS id, o_totalprice AS price FROM orders",
)
def src_headerless(spark, sf):
    """Each part file repeats the header line inside; a code pattern tells data from headers."""
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderstatus")
    # Two branches, so that even a small table is written as several parts.
    orders = stack([orders.filter("o_orderstatus = 'F'"), orders.filter("o_orderstatus <> 'F'")]).drop("o_orderstatus")
    coded = orders.withColumn("o_custkey", F.lpad(F.col("o_custkey").cast("string"), 12, "0"))
    path = write_csv(coded, shared_dir(spark, "headerless"))
    raw = read_headerless(spark, path, ["code", "id", "price"], F.col("code").rlike("^[0-9]+$"))
    return raw.select("code", F.col("id").try_cast("bigint").alias("id"), F.col("price").try_cast("double").alias("price"))


@query(
    "src_tagged_union",
    """SELECT o_orderkey AS id, o_totalprice AS price, NULL::VARCHAR AS priority,
        CASE WHEN year(o_orderdate) < 1996 THEN 1995 ELSE 1996 END::BIGINT AS era
      FROM orders WHERE year(o_orderdate) < 1998
    UNION ALL BY NAME
    SELECT o_orderkey AS id, o_totalprice AS price, o_orderpriority AS priority, 1998::BIGINT AS era
      FROM orders WHERE year(o_orderdate) >= 1998""",
)
def src_tagged_union(spark, sf):
    """Extracts of three eras, the last with one more column; the era is read from the path."""
    folder = shared_dir(spark, "eras")
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("price"), F.col("o_orderpriority").alias("priority"),
        F.year("o_orderdate").alias("year"),
    )
    old, new = orders.filter("year < 1998").drop("priority"), orders.filter("year >= 1998").drop("year")
    write_csv(old.filter("year < 1996").drop("year"), f"{folder}/era1995")
    write_csv(old.filter("year >= 1996").drop("year"), f"{folder}/era1996")
    write_csv(new.select("id", "price", "priority"), f"{folder}/era1998")
    two = read_tagged(spark, [f"{folder}/era1995", f"{folder}/era1996", f"{folder}/era1997"], "id bigint, price double")
    three = read_tagged(spark, [f"{folder}/era1998*"], "id bigint, price double, priority string")
    return stack([two, three]).select(
        "id", "price", "priority", year_in_path("source_file", r"era(\d{4})").cast("bigint").alias("era")
    )


@query(
    "src_many_headers",
    """SELECT o_orderkey AS id, o_totalprice AS price,
        CASE WHEN year(o_orderdate) >= 1994 THEN o_orderpriority END AS priority,
        CASE WHEN year(o_orderdate) >= 1996 THEN o_custkey END AS customer,
        strftime(o_orderdate, '%Y-%m') AS month, o_orderstatus AS status
      FROM orders""",
)
def src_many_headers(spark, sf):
    """An extract for each month and status, in three layouts over the years; three scans, however many files there are."""
    folder = shared_dir(spark, "extracts")
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("price"), F.col("o_orderpriority").alias("priority"),
        F.col("o_custkey").alias("customer"), F.date_format("o_orderdate", "yyyy-MM").alias("month"), F.col("o_orderstatus").alias("status"),
    )
    layouts = {
        "early": orders.filter("month < '1994'").drop("priority", "customer"),
        "middle": orders.filter("month >= '1994' AND month < '1996'").select("priority", "id", "price", "month", "status"),
        "late": orders.filter("month >= '1996'"),
    }
    for name, rows in layouts.items():
        parts = rows.repartition("month", "status").write.partitionBy("month", "status")
        parts.option("header", True).option("sep", ";").csv(f"{folder}/{name}")
    return stack(read_by_header(spark, f"{folder}/*/month=*/status=*", sep=";", tag="path")).select(
        F.col("id").try_cast("bigint").alias("id"), F.col("price").try_cast("double").alias("price"), "priority",
        F.col("customer").try_cast("bigint").alias("customer"), F.regexp_extract("path", r"month=([0-9-]+)", 1).alias("month"), F.regexp_extract("path", r"status=(\w)", 1).alias("status"),
    )


@query(
    "src_sheets_by_name",
    """SELECT lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS sheet, year(o_orderdate) AS year, count(*) AS n_orders
    FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_nationkey <> 5 GROUP BY 1, 2""",
)
def src_sheets_by_name(spark, sf):
    """One part per unit, named after it; the parts named by digits are read as one table."""
    folder = shared_dir(spark, "sheets")
    rows = customer_orders(spark, sf).groupBy("unit", "year").agg(F.sum("n").alias("n_orders"))
    code = F.lpad(F.col("unit").cast("string"), 2, "0")
    named = rows.select(F.when(F.col("unit") == 5, F.lit("notes")).otherwise(code).alias("sheet"), "year", "n_orders")
    named.write.partitionBy("sheet").option("header", True).option("sep", ";").csv(folder)
    sheets = read_tagged(spark, [f"{folder}/sheet=[0-9][0-9]"], "year int, n_orders bigint", tag="path")
    return sheets.select(F.regexp_extract("path", r"sheet=(\w+)", 1).alias("sheet"), big("year"), "n_orders")


@query(
    "filter_preamble",
    """SELECT year(o_orderdate) AS year, o_orderkey AS id,
      CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(floor(o_totalprice) AS BIGINT) END AS value FROM orders""",
)
def filter_preamble(spark, sf):
    """Three metadata rows stand above the year rows; unknown values are no numbers."""
    value = F.when(F.col("o_orderstatus") == "P", F.lit("n.d.")).otherwise(F.floor("o_totalprice").cast("string"))
    orders = table(spark, sf, "orders").select(
        F.year("o_orderdate").cast("string").alias("label"), value.alias("value"), F.col("o_orderkey").cast("string").alias("id")
    )
    preamble = spark.createDataFrame(
        [("idBank", "010751785", None), ("Dernière mise à jour", "16/04/2024", None), ("Période", None, None)], orders.schema
    )
    path = write_csv(preamble.unionByName(orders), shared_dir(spark, "preamble"))
    raw = read_delimited(spark, path, "label string, value string, id string")
    rows = skip_preamble(raw, "label", "^[0-9]{4}$")
    return rows.select(
        F.col("label").try_cast("bigint").alias("year"),
        F.col("id").try_cast("bigint").alias("id"),
        F.col("value").try_cast("bigint").alias("value"),
    )


SUPPLIERS = StructType(
    [
        StructField("id", IntegerType()),
        StructField("supplier", LongType()),
        StructField("unit", IntegerType()),
        StructField("Label", StringType()),
    ]
)


@query(
    "sink_append_table",
    "SELECT s_suppkey AS supplier, s_nationkey::BIGINT AS unit, s_name AS label FROM supplier",
)
def sink_append_table(spark, sf):
    """A table is created empty, then filled by two appends of differently named columns."""
    path = create_table(spark, shared_dir(spark, "dim_supplier"), SUPPLIERS)
    supplier = table(spark, sf, "supplier").withColumn("id", F.lit(0))
    mapping = {"s_suppkey": "SUPPLIER", "s_nationkey": "unit", "s_name": "label"}
    append_table(supplier.filter("s_nationkey < 10"), path, SUPPLIERS, mapping)
    append_table(supplier.filter("s_nationkey >= 10"), path, SUPPLIERS, mapping)
    stored = spark.read.schema(SUPPLIERS).parquet(path)
    return stored.select("supplier", big("unit"), F.col("Label").alias("label"))
