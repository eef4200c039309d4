"""Intermediate tables of this subpackage."""

from __future__ import annotations

from pyspark.sql import DataFrame

from panelspark import tables

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Rows of a few longs in one file; so few links, a megabyte, are not dealt out.
FILE_ROWS = 1 << 16


def _files(rows: int) -> int:
    return max(1, -(-rows // FILE_ROWS))


def small(df: DataFrame, rows: int) -> DataFrame:
    """``df``, made of so many rows of a few longs, in one partition if these fit into a file: then nothing is shuffled for them."""
    return df.coalesce(1) if rows <= FILE_ROWS else df


def settle(df: DataFrame, label: str, *partitions: str, rows: int | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back; its shuffle files go as soon as it is written.

    The table outlives lost executors and cuts the lineage, and its size on disk tells Catalyst what may be broadcast.

    ``rows``: ``df`` has at most so many rows of a few longs.  They are gathered in as few files as they need: every task that writes
    costs a folder, two files and, on a local disk, a process for the mode of each, which Hadoop forks from the executor.
    """
    spark = df.sparkSession
    if rows is not None and _files(rows) < int(spark.conf.get("spark.sql.shuffle.partitions")):
        df = df.repartition(_files(rows))
    path = tables.shared_dir(spark, label)
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.partitionBy(*partitions).parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    tables.drop_at_exit(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def drop(settled: DataFrame) -> None:
    """Deletes a settled table that nothing reads any more, so that it takes no disk while the rest runs."""
    for file in settled.inputFiles():
        place, files = tables._path(settled.sparkSession, file)
        files.delete(place, False)
