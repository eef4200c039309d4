"""Regions of sheets, and stored tables over several loads: all or nothing, checked, updated in place, with ids that go on."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from panelspark.queries.base import big
from panelspark.queries.registry import query
from panelspark.sinks.manifest import Constraints, ConstraintError, Warehouse
from panelspark.sinks.writers import write_csv
from panelspark.sources.regions import read_region
from panelspark.tables import drop_at_exit, shared_dir, table


def folder_for(spark, label: str) -> str:
    path = shared_dir(spark, label)
    drop_at_exit(spark, path)
    return path


@query(
    "src_region",
    """SELECT * FROM (
      SELECT c_nationkey::BIGINT AS sheet, 3 + row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS "row",
        c_name AS name, c_acctbal AS balance, CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END AS segment
      FROM customer
      UNION ALL
      SELECT c_nationkey, 3 + count(*) + footer, NULL, NULL, NULL FROM customer, range(1, 3) f(footer) GROUP BY c_nationkey, footer)
    WHERE "row" <= 52""",
)
def src_region(spark, sf):
    """Each nation's sheet has two title lines, a header, its customers, a total and a source; cells B3:D52 are read, the header in row 3.

    A sheet with fewer customers than that ends inside the region, so its last two lines are in it, as empty cells.
    """
    customers = table(spark, sf, "customer").select("c_nationkey", "c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    segment = F.when(F.col("c_mktsegment") == "BUILDING", "").otherwise(F.col("c_mktsegment"))
    body = customers.select(
        F.col("c_nationkey").alias("sheet"), F.lit(1).alias("part"), F.col("c_custkey").alias("at"),
        F.concat_ws(";", "c_custkey", "c_name", F.col("c_acctbal").cast("string"), segment).alias("value"),
    )
    around = [(0, 1, "Clients;;;"), (0, 2, ";;;"), (0, 3, "Code;Nom;Solde;Segment"), (2, 1, "Total;;;"), (2, 2, "Source : registre;;;")]
    frames = customers.groupBy(F.col("c_nationkey").alias("sheet")).agg(F.count(F.lit(1))).select(
        "sheet", F.inline(F.array(*[F.struct(F.lit(p).alias("part"), F.lit(a).cast("bigint").alias("at"), F.lit(v).alias("value")) for p, a, v in around]))
    )
    path = folder_for(spark, "region-sheets")
    lines = body.unionByName(frames).repartition("sheet").sortWithinPartitions("sheet", "part", "at")
    lines.select("sheet", "value").write.partitionBy("sheet").text(path)
    cells = read_region(spark, f"{path}/sheet=*", "'Clients'!B3:D52")
    sheet = F.regexp_extract("source_file", r"sheet=(\d+)", 1).try_cast("bigint")
    return cells.select(sheet.alias("sheet"), "row", F.col("Nom").alias("name"), F.col("Solde").try_cast("double").alias("balance"), F.col("Segment").alias("segment"))


def _schema(**columns) -> StructType:
    return StructType([StructField(n, t) for n, t in columns.items()])


SCHEMAS = {
    "region": _schema(id=LongType(), label=StringType()),
    "nation": _schema(id=LongType(), label=StringType(), region=LongType()),
    "supplier": _schema(id=LongType(), label=StringType(), nation=LongType(), balance=DoubleType()),
    "customer": _schema(id=LongType(), label=StringType(), nation=LongType(), balance=DoubleType()),
}
MAPPINGS = {
    "region": {"r_regionkey": "id", "r_name": "label"},
    "nation": {"n_nationkey": "id", "n_name": "label", "n_regionkey": "region"},
    "supplier": {"s_suppkey": "id", "s_name": "label", "s_nationkey": "nation", "s_acctbal": "balance"},
    "customer": {"c_custkey": "id", "c_name": "label", "c_nationkey": "nation", "c_acctbal": "balance"},
}
CONSTRAINTS = {
    "region": Constraints([["id"], ["label"]], ["id", "label"]),
    "nation": Constraints([["id"], ["label"]], ["id", "label", "region"], {"region": ("region", "id")}),
    "supplier": Constraints([["id"]], ["id", "label"], {"nation": ("nation", "id")}),
    "customer": Constraints([["id"]], ["id", "label"], {"nation": ("nation", "id")}),
}


def _loaded(spark, sf) -> tuple[Warehouse, list[tuple[str, str, int]]]:
    """The four tables after two good loads and one that is refused, and what that one would have broken."""
    folder = folder_for(spark, "warehouse")
    store = Warehouse(spark, f"{folder}/tables", SCHEMAS)

    def load(label, frames):
        files = {n: write_csv(df, f"{folder}/{label}/{n}_processed.csv") for n, df in frames.items()}
        store.load_files(files, CONSTRAINTS, MAPPINGS)

    whole = {n: table(spark, sf, n).select(*MAPPINGS[n]) for n in SCHEMAS}
    load("first", {n: whole[n] for n in ("region", "nation")})
    load("second", {n: whole[n] for n in ("supplier", "customer")})
    # Suppliers again, and new customers: some of nations that are not there, some without a name.
    more = whole["customer"].withColumn("c_custkey", -1 - F.col("c_custkey")).withColumn(
        "c_nationkey", F.when(F.col("c_acctbal") < 0, F.col("c_nationkey") + 100).otherwise(F.col("c_nationkey"))
    )
    more = more.withColumn("c_name", F.when(F.col("c_nationkey") != 3, F.col("c_name")))
    try:
        load("third", {"supplier": whole["supplier"], "customer": more})
    except ConstraintError as refused:
        return store, refused.broken
    return store, []


@query(
    "load_all_or_nothing",
    """SELECT 'region' AS "table", r_regionkey::BIGINT AS id, r_name AS label, NULL::BIGINT AS parent, NULL::DOUBLE AS balance FROM region
    UNION ALL SELECT 'nation', n_nationkey, n_name, n_regionkey, NULL FROM nation
    UNION ALL SELECT 'supplier', s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier
    UNION ALL SELECT 'customer', c_custkey, c_name, c_nationkey, c_acctbal FROM customer""",
)
def load_all_or_nothing(spark, sf):
    """What two loads of several files stored; a third one breaks constraints in both of its tables and stores neither."""
    store, _ = _loaded(spark, sf)

    def rows(name, parent, balance):
        value = F.col(balance) if balance else F.lit(None).cast("double")
        key = F.col(parent) if parent else F.lit(None).cast("bigint")
        return store.read(name).select(F.lit(name).alias("table"), "id", "label", key.alias("parent"), value.alias("balance"))

    found = [rows("region", None, None), rows("nation", "region", None), rows("supplier", "nation", "balance"), rows("customer", "nation", "balance")]
    return found[0].unionByName(found[1]).unionByName(found[2]).unionByName(found[3])


@query(
    "load_refused",
    """SELECT * FROM (
      SELECT 'supplier' AS "table", 'unique id' AS rule, 2 * count(*) AS n_rows FROM supplier
      UNION ALL SELECT 'customer', 'nation references nation', count(*) FROM customer WHERE c_acctbal < 0
      UNION ALL SELECT 'customer', 'required label', count(*) FROM customer WHERE c_acctbal >= 0 AND c_nationkey = 3)
    WHERE n_rows > 0""",
)
def load_refused(spark, sf):
    """Why the third load is refused: a row for each broken constraint."""
    return spark.createDataFrame(_loaded(spark, sf)[1], "table string, rule string, n_rows bigint")


ORDER = {"order": _schema(id=LongType(), status=StringType(), price=DoubleType(), version=LongType())}


@query(
    "upsert_stored",
    """WITH loads AS (
      SELECT o_orderkey AS id, o_orderstatus AS status, o_totalprice AS price, 1::BIGINT AS version, 0 AS load FROM orders
      UNION ALL SELECT o_orderkey, 'X', round(o_totalprice * 2, 2), 2, 1 FROM orders WHERE o_orderpriority = '1-URGENT'
      UNION ALL SELECT o_orderkey, 'stale', 0.0, 0, 1 FROM orders WHERE o_orderpriority = '2-HIGH'
      UNION ALL SELECT o_orderkey, 'Y', o_totalprice, 2, 2 FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'O'
      UNION ALL SELECT -1 - o_orderkey, 'new', o_totalprice, 1, 2 FROM orders WHERE o_orderpriority = '5-LOW')
    SELECT id, status, price, version FROM loads QUALIFY row_number() OVER (PARTITION BY id ORDER BY version DESC, load DESC) = 1""",
)
def upsert_stored(spark, sf):
    """A table kept by buckets: loaded, then updated twice; what a delta does not touch is not rewritten."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    key, status, price, priority = (F.col(c) for c in orders.columns)
    store = Warehouse(spark, folder_for(spark, "orders-store"), ORDER)

    def shaped(df, key, status, price, version):
        return df.select(key.alias("id"), status.alias("status"), price.alias("price"), F.lit(version).cast("bigint").alias("version"))

    urgent = orders.filter(priority == "1-URGENT")
    first = shaped(urgent, key, F.lit("X"), F.round(price * 2, 2), 2).unionByName(shaped(orders.filter(priority == "2-HIGH"), key, F.lit("stale"), F.lit(0.0), 0))
    second = shaped(urgent.filter(status == "O"), key, F.lit("Y"), price, 2).unionByName(shaped(orders.filter(priority == "5-LOW"), -1 - key, F.lit("new"), price, 1))
    for delta in (shaped(orders, key, status, price, 1), first, second):
        store.upsert("order", delta, ["id"], "version", ["status", "price"], buckets=16)
    return store.read("order")


NUMBERED = {"dim_customer": _schema(id=LongType(), nation=LongType(), customer=LongType())}


@query(
    "ids_over_loads",
    """WITH c AS (SELECT c_nationkey::BIGINT AS nation, c_custkey::BIGINT AS customer, c_mktsegment IN ('BUILDING', 'MACHINERY') AS early FROM customer),
      one AS (SELECT *, row_number() OVER (ORDER BY nation, md5(CAST(customer AS VARCHAR)), customer) AS id FROM c WHERE early),
      two AS (SELECT *, (SELECT count(*) FROM one) + row_number() OVER (ORDER BY nation, md5(CAST(customer AS VARCHAR)), customer) AS id FROM c WHERE NOT early)
    SELECT id, nation, customer, early FROM one UNION ALL SELECT id, nation, customer, early FROM two""",
)
def ids_over_loads(spark, sf):
    """Customers of two segments get ids; when all are loaded, these keep them and the others go on after the largest."""
    customers = table(spark, sf, "customer").select(
        big("c_nationkey", "nation"), big("c_custkey", "customer"), F.col("c_mktsegment").isin("BUILDING", "MACHINERY").alias("early")
    )
    store = Warehouse(spark, folder_for(spark, "numbered"), NUMBERED)
    store.number("dim_customer", customers.filter("early"), "nation", ["customer"])
    return store.number("dim_customer", customers, "nation", ["customer"]).select("id", "nation", "customer", "early")
