"""Sinks.  Every writer keeps the partitions of its input; ``files`` is there for callers who
want a small result in few files."""

from __future__ import annotations

import os
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from panelspark.plans.star import conform
from panelspark.sources.delimited import read_delimited
from panelspark.tables import shared_dir


def processed_path(folder: str, source: str) -> str:
    """``raw/a.csv`` → ``<folder>/a_processed.csv``."""
    base = os.path.basename(source.rstrip("/"))
    stem = base[: -len(".csv")] if base.endswith(".csv") else base
    return f"{folder.rstrip('/')}/{stem}_processed.csv"


def write_csv(df: DataFrame, path: str, sep: str = ";", files: int | None = None) -> str:
    """Write a headed CSV folder, replacing an earlier one."""
    out = df if files is None else df.coalesce(files)
    out.write.mode("overwrite").option("header", True).option("sep", sep).csv(path)
    return path


def create_table(spark: SparkSession, path: str, schema: StructType) -> str:
    """Create an empty table unless it is there already."""
    spark.createDataFrame([], schema).write.mode("ignore").parquet(path)
    return path


def append_table(df: DataFrame, path: str, schema: StructType, mapping: Mapping[str, str] | None = None) -> str:
    """Rename, conform to the table's columns and types, and append."""
    conform(df, mapping or {}, schema).write.mode("append").parquet(path)
    return path


def load_dimensions(
    spark: SparkSession,
    files: Mapping[str, str],
    schemas: Mapping[str, StructType],
    mappings: Mapping[str, Mapping[str, str]],
    folder: str,
) -> dict[str, str]:
    """Append every processed CSV to its dimension table: all of them, or none.

    All files are read, conformed and written to a staging folder first; any error there leaves the tables as they were, so a load can
    be repeated.  Publishing only copies what has been staged.
    """
    staging = {name: shared_dir(spark, f"staged-{name}") for name in files}
    for name, source in files.items():
        conform(read_delimited(spark, source), mappings.get(name) or {}, schemas[name]).write.parquet(staging[name])
    written = {}
    for name, path in staging.items():
        written[name] = f"{folder.rstrip('/')}/dim_{name}"
        spark.read.parquet(path).write.mode("append").parquet(written[name])
    return written


def write_jdbc(df: DataFrame, url: str, table: str, batch: int = 1000, properties: Mapping[str, str] | None = None) -> None:
    df.write.mode("append").option("batchsize", batch).jdbc(url, table, properties=dict(properties or {}))
