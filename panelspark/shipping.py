"""Makes the package importable in Python workers, whatever folder the session was started from."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


#: Rows go to Python workers in batches of about this size, whatever their number, so that long texts cannot fill a worker.
_BATCH = ("spark.sql.execution.arrow.maxBytesPerBatch", "1m")


def ship(spark: SparkSession) -> None:
    """Send the package to the executors, once per application, and bound the batches that reach their Python workers.

    Task functions are pickled by reference to their module, so workers must be able to import it
    even where the package is not installed.  Spark serves the archive from the driver.
    """
    spark.conf.set(*_BATCH)
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="panelspark-code-"), "panelspark.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, names in os.walk(package):
            for name in sorted(n for n in names if n.endswith(".py")):
                path = os.path.join(folder, name)
                out.write(path, os.path.relpath(path, os.path.dirname(package)))
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)
