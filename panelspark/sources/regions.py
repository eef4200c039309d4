"""Rectangular regions of delimited exports of sheets: ``A3:Z115``, ``B5``, ``A4:D``.

Lines are numbered exactly, without one task for each file: every task counts the lines of its own stretch of a file, and a running
sum over the stretches (one row for each) tells how many lines stand before it.  A line is a row of the sheet, so fields with
line breaks inside quotes are not supported.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelspark.shipping import ship
from panelspark.sources.delimited import matching_paths
from panelspark.tables import settle

_CELLS = re.compile(r"(?:'[^']*'!|[^'!]*!)?\$?([A-Z]+)\$?(\d+)(?::\$?([A-Z]+)\$?(\d+)?)?\Z")


@dataclass(frozen=True)
class Region:
    """Rows and columns from 1, ends included; no end where it is None."""

    first_row: int
    first_column: int
    last_row: int | None = None
    last_column: int | None = None

    @staticmethod
    def parse(address: str) -> Region:
        """``A3:Z115``; a sheet name before ``!`` is left to the caller, a missing end means all that follows."""
        found = _CELLS.match(address)
        if not found:
            raise ValueError(f"{address!r} is no region")
        left, top, right, bottom = found.groups()
        region = Region(int(top), column_number(left), int(bottom) if bottom else None, column_number(right) if right else None)
        if region.first_row < 1 or (region.last_row or region.first_row) < region.first_row or (region.last_column or region.first_column) < region.first_column:
            raise ValueError(f"{address!r} is an empty region")
        return region


def column_number(letters: str) -> int:
    """``A`` → 1, ``Z`` → 26, ``AA`` → 27."""
    n = 0
    for c in letters:
        n = 26 * n + ord(c) - ord("A") + 1
    return n


def column_letters(number: int) -> str:
    letters = ""
    while number:
        number, rest = divmod(number - 1, 26)
        letters = chr(ord("A") + rest) + letters
    return letters


def numbered_lines(spark: SparkSession, paths: Sequence[str], first: int = 1, last: int | None = None, encoding: str = "UTF-8") -> DataFrame:
    """(file, line, value): the lines ``first`` to ``last`` of each file, numbered from 1.

    Of a stretch only what may be in range is written to the shared folder: no line whose number in its stretch is beyond ``last``.
    """
    ship(spark)
    found = matching_paths(spark, paths)
    if not found:
        raise FileNotFoundError(f"none of these paths exists: {list(paths)}")
    lines = spark.read.option("encoding", encoding).text(found)
    lines = lines.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows of a stretch come one after the other, in the order of the file.
        now, n = None, 0

        def total() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"file": [now[0]], "start": [now[1]], "nth": pa.array([None], pa.int64()), "n": [n], "value": pa.array([None], pa.string())})

        for batch in batches:
            files, starts = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            k = 0
            while k < len(files):
                if now != (files[k], starts[k]):
                    if now is not None:
                        yield total()
                    now, n = (files[k], starts[k]), 0
                end = k
                while end < len(files) and starts[end] == now[1] and files[end] == now[0]:
                    end += 1
                kept = end - k if last is None else max(0, min(end - k, last - n))
                if kept:
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(1).slice(k, kept), batch.column(2).slice(k, kept), pa.array(range(n + 1, n + kept + 1), pa.int64()), pa.nulls(kept, pa.int64()), batch.column(0).slice(k, kept)],
                        names=["file", "start", "nth", "n", "value"],
                    )
                n, k = n + end - k, end
        if now is not None:
            yield total()

    counted = settle(lines.mapInArrow(count, "file string, start long, nth long, n long, value string"), "region-lines")
    # One row for each stretch of a file.
    earlier = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    before = counted.filter("nth is null").select("file", "start", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    before = before if last is None else before.filter(F.col("before") < last)
    numbered = counted.filter("nth is not null").join(before, ["file", "start"]).select("file", (F.col("before") + F.col("nth")).alias("line"), "value")
    return numbered.filter(F.col("line") >= first) if last is None else numbered.filter(F.col("line").between(first, last))


def read_region(
    spark: SparkSession, paths: str | Sequence[str], address: str, sep: str = ";", header: bool = True, encoding: str = "UTF-8", tag: str = "source_file", line: str = "row"
) -> DataFrame:
    """The cells of a region of one or many files of one layout, as text, with the file and the row of the sheet.

    With ``header`` the first row of the region names the columns; files whose headers differ are an error.  Without it columns have
    their letters.  A region without a last column ends with the header's last cell.  Empty cells are NULL.
    """
    region = Region.parse(address)
    lines = numbered_lines(spark, [paths] if isinstance(paths, str) else paths, region.first_row, region.last_row, encoding)
    first, last = region.first_column, region.last_column
    names = None
    if header or last is None:
        # One line of each file; they must be the same, so at most two are fetched.
        heads = lines.filter(F.col("line") == region.first_row).select("value").distinct().limit(2).collect()
        if len(heads) != 1:
            raise ValueError("the files have different headers" if heads else f"no file has a row {region.first_row}")
        width = heads[0].value.count(sep) + 1 if last is None else last
        cells = spark.range(1).select(F.from_csv(F.lit(heads[0].value), _cells(width), {"sep": sep}).alias("c")).first().c
        last = last or width
        if header:
            names = [cells[k] or column_letters(k + 1) for k in range(first - 1, last)]
    names = names or [column_letters(k + 1) for k in range(first - 1, last)]
    if len(set(names)) != len(names):
        raise ValueError(f"columns of one name in {names}")
    cells = F.from_csv("value", _cells(last), {"sep": sep}).alias("_cells")
    rows = (lines.filter(F.col("line") > region.first_row) if header else lines).select(F.col("file").alias(tag), F.col("line").alias(line), cells)
    return rows.select(tag, line, *[F.col("_cells")[f"c{k}"].alias(n) for k, n in zip(range(first - 1, last), names)])


def _cells(width: int) -> str:
    return ", ".join(f"c{k} string" for k in range(width))
