"""Connected components of a table of links, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.llm.store import settle, small


def _nearest(edges: DataFrame) -> DataFrame:
    """(key, least): for every ``a`` its smallest ``b``.

    The key is an expression, so the join below deals both its sides anew and Spark can split the links of a hub.
    """
    return edges.groupBy("a").agg(F.min("b").alias("least")).select(F.expr("a ^ 0").alias("key"), "least")


def components(links: DataFrame, rows: int | None = None) -> DataFrame:
    """(node, root) for every node of ``links`` (two columns of longs): root is the smallest node it reaches.

    Links that occur twice or join a node with itself do no harm.  Each round is written to the shared folder, so a lost
    executor costs one round at most; a component of n nodes takes about log(n) rounds.  Links that fit into a file are
    not dealt out in a round.  ``rows``: so many links there are at most, if that is known.
    """

    def told(edges: DataFrame) -> tuple:
        return edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.col("b").cast("decimal(38,0)"))).first()

    a, b = (F.col(c).cast("long") for c in links.columns[:2])
    edges = settle(links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).filter("a <> b").distinct(), "links", rows=rows)
    now = told(edges)
    while True:
        before, n = now, now[0]
        # Large star: all greater neighbours of a node move to its smallest neighbour (or itself).
        both = small(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))), n)
        moved = both.join(_nearest(both), F.col("a") == F.col("key")).filter("b > a").select(
            F.col("b").alias("a"), F.least("least", F.col("a")).alias("b")
        )
        large = small(moved.filter("a <> b"), n).distinct()
        # Small star: a node and its smaller neighbours move to the smallest of them.
        moved = large.join(_nearest(large), F.col("a") == F.col("key"))
        pairs = moved.select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("least").alias("b")), F.struct("a", F.col("least").alias("b")))).alias("e"))
        edges = settle(small(pairs.select("e.*").filter("a <> b"), n).distinct(), "small-star")
        now = told(edges)
        if now == before:
            break
    edges = small(edges, now[0])
    roots = edges.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
