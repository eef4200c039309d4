"""Token counts of documents in flat token files that have no index: only an end-of-document id between documents.

Files are read in blocks.  Within a block all ends are found at once, and all documents but the first and the last are counted
on the spot.  A prefix scan over the blocks of a file then tells where the document that a block starts with began, and how many
came before it.

A file may end without an end id: its last document is reported as open.  An empty document has length 0.  An empty file has
no document.  Bytes after the last whole token are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelspark.llm.store import settle
from panelspark.llm.tokens import word_encoder
from panelspark.llm.words import buffer_of, slices

#: Blocks of one step of the prefix scan.
STEP = 1024


def write_flat(docs: DataFrame, tokenizer: str, path: str, end_id: int, text_col: str = "text", rows_per_file: int = 4096) -> None:
    """Writes the tokens of all documents as flat files of 16-bit little-endian ids, each document followed by ``end_id``.

    Null texts are empty; an end id spelt out in a text is ordinary text.  The text writer puts the bytes of a row down as they are and the separator after them; so
    the separator is the end id, and there is no line end or header.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(tokenizer, literal=True)
        for batch in batches:
            for _, _, d, o in slices(*buffer_of(batch.column(0))):
                ids, sizes = encoder.encode(d, o)
                at = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32) * 2
                data = pa.py_buffer(ids.astype("<u2").tobytes())
                yield pa.RecordBatch.from_arrays([pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(at), data])], names=["ids"])

    separator = bytes([end_id & 255, end_id >> 8]).decode("latin-1")
    tokens = docs.select(text_col).mapInArrow(run, "ids binary").select(F.col("ids").cast("string").alias("value"))
    tokens.write.option("lineSep", separator).option("encoding", "ISO-8859-1").option("maxRecordsPerFile", rows_per_file).text(path)


def file_number(name: str) -> Column:
    """Number of a file from its name: part, then part of the part; a hash of a name of another form."""
    part, piece = (F.regexp_extract(name, r"^part-(\d+)-.*-c(\d{3,})(\.\w+)*$", k) for k in (1, 2))
    return F.when(part == "", F.xxhash64(name)).otherwise(F.concat(part, F.lpad(piece, 6, "0")).try_cast("long"))


def read_blocks(spark: SparkSession, path: str, end_id: int, block_tokens: int = 1 << 16) -> DataFrame:
    """(file, block, start, tokens, ends) of flat token files: for each block its first token's place and the places of its ends.

    ``file`` is the :func:`file_number`.
    """
    files = spark.read.format("binaryFile").load(path).select(F.regexp_extract("path", r"([^/]*)$", 1).alias("name"), "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.frombuffer(content.as_buffer(), "<u2", content.as_buffer().size // 2)
                for block, start in enumerate(range(0, len(ids), block_tokens)):
                    part = ids[start : start + block_tokens]
                    ends = np.flatnonzero(part == end_id) + start
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([v], pa.int64()) for v in (file, block, start, len(part))] + [pa.array([ends], pa.list_(pa.int64()))],
                        names=["file", "block", "start", "tokens", "ends"],
                    )

    return files.select(file_number("name").alias("file"), "content").mapInArrow(run, "file long, block long, start long, tokens long, ends array<long>")


def _scan(blocks: DataFrame) -> DataFrame:
    """(file, block, docs_before, last_end): ends in earlier blocks of the file, and the place of the last of them.

    Steps of :data:`STEP` blocks are summed up first, so that no window holds more than that many blocks, or the steps of one file.
    """
    narrow = blocks.select("file", F.floor(F.col("block") / STEP).alias("step"), "block", F.size("ends").alias("n"), F.try_element_at("ends", F.lit(-1)).alias("last"))
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    of_file = before.partitionBy("file").orderBy("step")
    steps = narrow.groupBy("file", "step").agg(F.sum("n").alias("n"), F.max("last").alias("last"))
    steps = steps.select("file", "step", F.sum("n").over(of_file).alias("n_steps"), F.max("last").over(of_file).alias("last_steps"))
    of_step = before.partitionBy("file", "step").orderBy("block")
    inner = narrow.select("file", "step", "block", F.sum("n").over(of_step).alias("n_blocks"), F.max("last").over(of_step).alias("last_blocks"))
    zero = F.lit(0)
    return inner.join(steps, ["file", "step"]).select(
        "file", "block", (F.coalesce("n_steps", zero) + F.coalesce("n_blocks", zero)).alias("docs_before"), F.coalesce("last_blocks", "last_steps").alias("last_end")
    )


def count_tokens(blocks: DataFrame) -> DataFrame:
    """One row per document of the files of ``blocks`` (see :func:`read_blocks`): file, document (from 0), start, n_tokens, open.

    The end id is not counted.
    """
    blocks = settle(blocks, "token-blocks")
    with_last = blocks.join(_scan(blocks), ["file", "block"])
    found = with_last.select("file", "docs_before", F.concat(F.array("last_end"), "ends").alias("before"), F.posexplode("ends").alias("nth", "end"))
    start = F.coalesce(F.col("before")[F.col("nth")] + 1, F.lit(0))
    closed = found.select("file", (F.col("docs_before") + F.col("nth")).alias("document"), start.alias("start"), "end", F.lit(False).alias("open"))
    # What follows the last end of a file, if anything does.
    whole = blocks.groupBy("file").agg(
        F.max(F.col("start") + F.col("tokens")).alias("end"), F.max(F.try_element_at("ends", F.lit(-1))).alias("last"), F.sum(F.size("ends")).alias("document")
    )
    start = F.coalesce(F.col("last") + 1, F.lit(0))
    rest = whole.filter(start < F.col("end")).select("file", "document", start.alias("start"), "end", F.lit(True).alias("open"))
    return closed.unionByName(rest).select("file", "document", "start", (F.col("end") - F.col("start")).alias("n_tokens"), "open")
