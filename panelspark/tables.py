"""Session helpers and lazy table access."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


#: Schemas by path and the time when the path was last changed.
_SCHEMAS: dict[str, tuple[int, StructType]] = {}


def _path(spark: SparkSession, path: str):
    """(Hadoop path, its file system)."""
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Lazily open ``<root>/<name>.parquet``; filters and columns are pruned into the scan.

    The schema is inferred once per path and change of it, since inference starts a job each time.
    """
    path = f"{root.rstrip('/')}/{name}.parquet"
    place, files = _path(spark, path)
    changed = files.getFileStatus(place).getModificationTime()
    if _SCHEMAS.get(path, (None,))[0] != changed:
        _SCHEMAS[path] = (changed, spark.read.parquet(path).schema)
    return spark.read.schema(_SCHEMAS[path][1]).parquet(path)


def drop_at_exit(spark: SparkSession, path: str) -> None:
    """The application owns what it settles: the folder goes when the application ends."""
    place, files = _path(spark, path)
    files.deleteOnExit(place)


def shared_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder for ``label`` below the shared folder that the cluster names.

    ``spark.checkpoint.dir`` is read from the session.  Only a local-mode session
    may leave it unset (tests): it then gets a temporary folder of its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="panelspark-")
        spark.sparkContext.setCheckpointDir(base)
    return os.path.join(base, f"{label}-{uuid.uuid4().hex}")


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write an intermediate result to the shared folder and read it back.

    Used where several branches of a plan need the same reduced table: it is computed once,
    outlives lost executors, and its file sizes tell Catalyst what may be broadcast.
    """
    path = shared_dir(df.sparkSession, label)
    df.write.parquet(path)
    drop_at_exit(df.sparkSession, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settle_all(frames: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Settle independent tables at the same time, so their jobs share the cluster."""
    with ThreadPoolExecutor(max_workers=min(8, len(frames))) as pool:
        return dict(zip(frames, pool.map(settle, frames.values(), frames)))
