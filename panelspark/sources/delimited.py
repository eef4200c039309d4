"""Delimited sources.  Columns are read as text unless a schema is given: no inference pass over
the data, and codes such as ``01`` keep their zeros in every file."""

from __future__ import annotations

import re
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

SEPARATORS = (";", ",")


def matching_paths(spark: SparkSession, patterns: Sequence[str]) -> list[str]:
    """Existing paths (or matches of globs) on whatever file system the paths name, sorted per pattern."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    found: list[str] = []
    for pattern in patterns:
        path = jvm.org.apache.hadoop.fs.Path(pattern)
        statuses = path.getFileSystem(conf).globStatus(path)
        found.extend(sorted(str(s.getPath().toString()) for s in statuses or []))
    return found


def _reader(spark: SparkSession, schema: StructType | str | None, sep: str, header: bool, encoding: str):
    reader = spark.read.option("header", header).option("sep", sep).option("encoding", encoding)
    return reader if schema is None else reader.schema(schema).option("enforceSchema", True)


def read_delimited(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: StructType | str | None = None,
    sep: str = ";",
    header: bool = True,
    encoding: str = "UTF-8",
) -> DataFrame:
    """Read one or many files of one layout; a field that does not fit its type becomes NULL."""
    paths = [path] if isinstance(path, str) else list(path)
    return _reader(spark, schema, sep, header, encoding).csv(paths)


def sniff_separator(spark: SparkSession, path: str) -> str:
    """``;`` if the first two lines hold more of them than commas, else ``,``.

    Two lines are fetched, whatever the file's size.  If the choice leaves a single column and
    the other separator does not, the other one is taken.
    """
    lines = [row.value for row in spark.read.text(path).limit(2).collect()]
    counts = {s: sum(line.count(s) for line in lines) for s in SEPARATORS}
    chosen = ";" if counts[";"] > counts[","] else ","
    other = "," if chosen == ";" else ";"
    return chosen if counts[chosen] or not counts[other] else other


def read_any(spark: SparkSession, path: str, schema: StructType | str | None = None, rows: int | None = None) -> DataFrame:
    """Read with the sniffed separator; ``rows`` limits a preview, the default is all of the data."""
    df = read_delimited(spark, path, schema, sniff_separator(spark, path))
    return df if rows is None else df.limit(rows)


def read_tagged(
    spark: SparkSession,
    paths: Sequence[str],
    schema: StructType | str | None = None,
    sep: str = ";",
    tag: str = "source_file",
    header: bool = True,
) -> DataFrame:
    """One scan over many files of one layout, each row tagged with its file; absent paths are skipped."""
    found = matching_paths(spark, paths)
    if not found:
        raise FileNotFoundError(f"none of these paths exists: {list(paths)}")
    return read_delimited(spark, found, schema, sep, header).withColumn(tag, file_path())


def file_path() -> Column:
    """The file of a row.  The path arrives percent-encoded; a plus sign in it is a plus sign."""
    return F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))


def read_each(spark: SparkSession, pattern: str, sep: str = ",", tag: str = "source_file") -> list[DataFrame]:
    """One DataFrame per file, for files whose columns differ; all columns are text."""
    found = matching_paths(spark, [pattern])
    if not found:
        raise FileNotFoundError(f"no file matches {pattern}")
    return [read_delimited(spark, path, sep=sep).withColumn(tag, F.lit(path)) for path in found]


def data_files(spark: SparkSession, pattern: str) -> list[str]:
    """The files that a glob matches, or that lie in a folder which it matches; hidden ones and markers are left out."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    found = []
    for name in matching_paths(spark, [pattern]):
        path = jvm.org.apache.hadoop.fs.Path(name)
        inside = path.getFileSystem(conf).listStatus(path)
        found += sorted(str(s.getPath().toString()) for s in inside if s.isFile() and str(s.getPath().getName())[0] not in "._")
    return found


def first_line(spark: SparkSession, path: str, encoding: str = "UTF-8") -> str | None:
    """The first line of a file, compressed ones included; no more than its first buffer is read.  None if the file is empty."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    name = jvm.org.apache.hadoop.fs.Path(path)
    stream = name.getFileSystem(conf).open(name)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(name)
        data = stream if codec is None else codec.createInputStream(stream)
        line = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(data, encoding)).readLine()
    finally:
        stream.close()
    return None if line is None else str(line).lstrip("\ufeff").rstrip()


def read_by_header(spark: SparkSession, pattern: str, sep: str = ",", tag: str = "source_file", encoding: str = "UTF-8") -> list[DataFrame]:
    """One DataFrame, and one scan, for each distinct header of the files; all columns are text, rows are tagged with their file.

    Only first lines are read to tell the headers, several files at a time.  A header may not hold a line break inside quotes.
    Files that are empty have no header and are left out; files with nothing but a header give no rows.  Headers come in the order of
    their first files.
    """
    files = data_files(spark, pattern)
    if not files:
        raise FileNotFoundError(f"no file matches {pattern}")
    with ThreadPoolExecutor(16) as pool:
        lines = list(pool.map(lambda path: first_line(spark, path, encoding), files))
    groups: dict[str, list[str]] = {}
    for line, path in zip(lines, files):
        if line is not None:
            groups.setdefault(line, []).append(path)
    return [read_delimited(spark, paths, sep=sep, encoding=encoding).withColumn(tag, file_path()) for paths in groups.values()]


def read_headerless(
    spark: SparkSession, path: str | Sequence[str], names: Sequence[str], is_data: Column, sep: str = ";"
) -> DataFrame:
    """Files without a usable header: columns are named by position, and rows that are no data
    (header lines repeated inside) are filtered out by ``is_data`` over the new names."""
    return read_delimited(spark, path, sep=sep, header=False).toDF(*names).filter(is_data)


def skip_preamble(df: DataFrame, column: str, pattern: str) -> DataFrame:
    """Keep the rows of a region whose ``column`` matches, dropping title and metadata rows above it."""
    return df.filter(F.col(column).rlike(pattern))


def safe_name(name: str) -> str:
    """``Parc installé éolien (MW)`` → ``Parc_installé_éolien_MW``."""
    return re.sub(r"\W+", "_", name.strip()).strip("_")


def sanitise_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[safe_name(c) for c in df.columns])


def stack(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by name; columns that a part lacks become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
