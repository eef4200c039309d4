"""Database reads: the query runs in the database, the rows arrive in parallel partitions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(
    url: str,
    query: str,
    partition_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 1,
    fetch_size: int = 10_000,
    properties: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Options of a pushed-down subquery, split over ``partition_column`` when its bounds are given."""
    options = {"url": url, "dbtable": f"({query}) AS source", "fetchsize": str(fetch_size), **(properties or {})}
    if partition_column is not None:
        if bounds is None:
            raise ValueError("a partition column needs its lower and upper bound")
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(partitions),
        }
    return options


def read_query(spark: SparkSession, url: str, query: str, **kwargs) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(url, query, **kwargs)).load()
