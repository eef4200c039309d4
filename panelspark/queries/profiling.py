"""Profiles of whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelspark.operators import profile
from panelspark.queries.base import big
from panelspark.queries.registry import query
from panelspark.tables import table

# All numeric columns of the two tables.
LINE_NUMBERS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]
ORDER_NUMBERS = ["o_orderkey", "o_custkey", "o_totalprice"]


def _union(template: str, columns) -> str:
    """One row per column; ``{v}`` is its value as a double."""
    return "\nUNION ALL ".join(template.format(c=c, v=f"{c}::DOUBLE") for c in columns)


@query(
    "profile_shape",
    "\nUNION ALL ".join(
        f"SELECT '{name}' AS \"column\", {i}::BIGINT AS position, '{kind}' AS type, count(*) AS n_rows, count({name}) AS n_values FROM j"
        for i, (name, kind) in enumerate(
            [("doc_id", "bigint"), ("text", "string"), ("lang", "string"), ("source", "string"), ("n_chars", "bigint"), ("quality", "int"), ("toxic", "int")]
        )
    ).join(["WITH j AS (SELECT doc_id, text, lang, source, n_chars, quality, toxic FROM documents LEFT JOIN labels USING (doc_id)) ", ""]),
)
def profile_shape(spark, sf):
    return profile.shape(_documents(spark, sf))


def _documents(spark, sf):
    return table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")


@query(
    "profile_missing",
    "WITH j AS (SELECT doc_id, text, lang, source, n_chars, quality, toxic FROM documents LEFT JOIN labels USING (doc_id)) "
    + _union(
        "SELECT '{c}' AS \"column\", count(*) FILTER ({c} IS NULL) AS n_missing, "
        "round(count(*) FILTER ({c} IS NULL) * 100.0 / count(*), 4) AS pct_missing FROM j",
        ["doc_id", "text", "lang", "source", "n_chars", "quality", "toxic"],
    ),
)
def profile_missing(spark, sf):
    return profile.missing(_documents(spark, sf))


@query(
    "profile_summary",
    _union(
        "SELECT '{c}' AS \"column\", count(*) AS n_rows, count(DISTINCT {c}) AS n_distinct, round(min({v}), 6) AS min_value, "
        "round(max({v}), 6) AS max_value FROM lineitem",
        LINE_NUMBERS,
    ),
)
def profile_summary(spark, sf):
    return profile.summary(table(spark, sf, "lineitem"), LINE_NUMBERS).withColumn(
        "n_rows", F.col("n_rows").cast("bigint")
    )


@query(
    "profile_describe",
    _union(
        "SELECT '{c}' AS \"column\", count({c}) AS n, round(avg({v}), 4) AS mean, round(stddev_samp({v}), 4) AS std, "
        "round(min({v}), 4) AS min, round(quantile_cont({v}, 0.25), 4) AS p25, round(quantile_cont({v}, 0.5), 4) AS p50, "
        "round(quantile_cont({v}, 0.75), 4) AS p75, round(max({v}), 4) AS max FROM lineitem",
        LINE_NUMBERS,
    ),
)
def profile_describe(spark, sf):
    return profile.describe(table(spark, sf, "lineitem"), LINE_NUMBERS)


@query(
    "profile_describe_orders",
    _union(
        "SELECT '{c}' AS \"column\", count({c}) AS n, round(avg({v}), 4) AS mean, round(stddev_samp({v}), 4) AS std, "
        "round(min({v}), 4) AS min, round(quantile_cont({v}, 0.25), 4) AS p25, round(quantile_cont({v}, 0.5), 4) AS p50, "
        "round(quantile_cont({v}, 0.75), 4) AS p75, round(max({v}), 4) AS max FROM orders",
        ORDER_NUMBERS,
    ),
)
def profile_describe_orders(spark, sf):
    return profile.describe(table(spark, sf, "orders"), ORDER_NUMBERS)


@query(
    "profile_distinct",
    _union("SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS n_distinct FROM documents", ["text", "lang", "source"]),
)
def profile_distinct(spark, sf):
    return profile.distinct_counts(table(spark, sf, "documents"), ["text", "lang", "source"])


@query(
    "profile_topk",
    "WITH v AS ("
    + _union("SELECT '{c}' AS \"column\", {c} AS value, count(*) AS n FROM documents GROUP BY 2", ["text", "lang", "source"])
    + """), q AS (SELECT "column" FROM v GROUP BY 1 HAVING count(value) < 50)
    SELECT "column", value, n, row_number() OVER (PARTITION BY "column" ORDER BY n DESC, value) AS position
    FROM v WHERE value IS NOT NULL AND "column" IN (SELECT "column" FROM q)
    QUALIFY row_number() OVER (PARTITION BY "column" ORDER BY n DESC, value) <= 10""",
)
def profile_topk(spark, sf):
    return profile.top_values(table(spark, sf, "documents"), ["text", "lang", "source"])


_BOUNDS = """WITH v AS (SELECT 'value' AS "column", value AS v FROM events UNION ALL
      SELECT 'event_id', event_id::DOUBLE FROM events UNION ALL SELECT 'user_id', user_id::DOUBLE FROM events),
    m AS (SELECT "column", avg(v) AS mean, stddev_samp(v) AS std FROM v GROUP BY 1),
    x AS (SELECT v."column", v, mean, std, mean - 3 * std AS lower, mean + 3 * std AS upper FROM v JOIN m USING ("column")
      WHERE v < mean - 3 * std OR v > mean + 3 * std)"""


@query(
    "profile_outliers",
    f"""{_BOUNDS}
    SELECT "column", round(max(mean), 4) AS mean, round(max(std), 4) AS std, round(max(lower), 4) AS lower,
      round(max(upper), 4) AS upper, count(*) AS n_outliers,
      round(count(*) * 100.0 / (SELECT count(*) FROM events), 4) AS pct_outliers FROM x GROUP BY 1""",
)
def profile_outliers(spark, sf):
    return profile.outliers(table(spark, sf, "events"), ["value", "event_id", "user_id"])


@query(
    "profile_outlier_examples",
    f"""{_BOUNDS} SELECT "column", v AS value, row_number() OVER (PARTITION BY "column" ORDER BY v) AS position FROM x
    QUALIFY row_number() OVER (PARTITION BY "column" ORDER BY v) <= 5""",
)
def profile_outlier_examples(spark, sf):
    return profile.outlier_examples(table(spark, sf, "events"), ["value", "event_id", "user_id"])


@query(
    "profile_corr",
    "\nUNION ALL ".join(
        f"SELECT '{a}' AS column_a, '{b}' AS column_b, round(corr({a}, {b}), 6) AS corr FROM lineitem"
        for a in LINE_NUMBERS
        for b in LINE_NUMBERS
    ),
)
def profile_corr(spark, sf):
    return profile.correlations(table(spark, sf, "lineitem"), LINE_NUMBERS)


@query(
    "profile_preview",
    """SELECT o_orderkey AS id, o_custkey AS customer, o_orderstatus AS status, o_totalprice AS price FROM orders
    ORDER BY o_orderkey LIMIT 5""",
)
def profile_preview(spark, sf):
    rows = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), big("o_custkey", "customer"), F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("price"),
    )
    return profile.preview(rows, 5, [F.asc("id")])
