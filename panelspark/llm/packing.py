"""Packs documents into sequences by minimum bin slack.

Each bin takes the largest length that is left, and a subset-sum dynamic program over bit sets finds the
combination of available lengths that fills the rest best.  Which lengths go together depends on their histogram alone,
which has as many entries as a sequence has tokens: the plan is made from that, and every combination is repeated as
often as its lengths last.  Pieces are numbered within their length on the executors and look their place up in the plan.

Null texts are empty; an empty document is its closing id alone.  Repeated rows are packed like any others.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelspark.llm.store import settle
from panelspark.llm.tokens import word_encoder
from panelspark.llm.words import buffer_of, slices

#: Gives the ids of a run of texts and their number in each.
Encode = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


def fill(counts: dict[int, int], capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Bins for so many pieces of each length: (how many such bins, [(length, pieces of it in the bin)])."""
    left = {n: c for n, c in sorted(counts.items(), reverse=True) if c > 0}
    if any(not 0 < n <= capacity for n in left):
        raise ValueError("piece lengths must lie between 1 and the capacity")
    bins = []
    while left:
        largest = next(iter(left))
        combination = {largest: 1}
        room = capacity - largest
        # Bit s of ``reach``: some of the lengths so far add up to s.  Multiples are split into powers of two.
        reach, mask, goal, steps = 1, (1 << room + 1) - 1, 1 << room, []
        for n, c in left.items():
            c = min(c - (n == largest), room // n)
            k = 1
            while c > 0 and not reach & goal:
                take = min(k, c)
                steps.append((n, take, reach))
                reach |= (reach << n * take) & mask
                c, k = c - take, 2 * k
            if reach & goal:
                break
        best = reach.bit_length() - 1
        for n, take, before in reversed(steps):
            if not before >> best & 1:
                combination[n] = combination.get(n, 0) + take
                best -= n * take
        repeat = min(left[n] // m for n, m in combination.items())
        for n, m in combination.items():
            left[n] -= repeat * m
            if not left[n]:
                del left[n]
        bins.append((repeat, sorted(combination.items(), reverse=True)))
    return bins


def slots(bins: list[tuple[int, list[tuple[int, int]]]]) -> np.ndarray:
    """The plan as rows (length, first rank, pieces of the length in a bin, first bin, offset), sorted by the first two."""
    used: dict[int, int] = {}
    rows, base = [], 0
    for repeat, combination in bins:
        offset = 0
        for n, m in combination:
            rows.append((n, used.get(n, 0), m, base, offset))
            used[n] = used.get(n, 0) + repeat * m
            offset += n * m
        base += repeat
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def pieces(docs: DataFrame, encode: Callable[[], Encode], id_col: str, text_col: str, capacity: int, end_id: int) -> DataFrame:
    """(id, piece, start, length, crc, task, rank): documents cut at the capacity; rank counts the pieces of a length in a task."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, task, seen = encode(), TaskContext.get().partitionId(), [0] * (capacity + 1)
        for batch in batches:
            data, offsets = buffer_of(batch.column(1))
            found: list[tuple[int, int, int, int, int, int]] = []
            for first, _, d, o in slices(data, offsets):
                ids, sizes = encoder(d, o)
                at = 0
                for k, n in enumerate(sizes.tolist()):
                    own = np.empty(n + 1, "<u4")
                    own[:n], own[n] = ids[at : at + n], end_id
                    at += n
                    for piece, start in enumerate(range(0, n + 1, capacity)):
                        part = own[start : start + capacity]
                        found.append((first + k, piece, start, len(part), zlib.crc32(part), seen[len(part)]))
                        seen[len(part)] += 1
            cols = np.array(found, np.int64).reshape(-1, 6)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(cols[:, 0])), pa.array(cols[:, 1].astype(np.int32)), *(pa.array(cols[:, i]) for i in (2, 3, 4)),
                 pa.array(np.full(len(cols), task)), pa.array(cols[:, 5])],
                names=["id", "piece", "start", "length", "crc", "task", "rank"],
            )

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, piece int, start long, length long, crc long, task long, rank long")


def pack(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = 2048, end_id: int = 0
) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id, offset.

    ``tokenizer`` is the path of a tokenizer file (see :class:`panelspark.llm.tokens.WordEncoder`), the same on all machines.
    """
    cut = settle(pieces(docs, lambda: word_encoder(tokenizer).encode, id_col, text_col, capacity, end_id), "pieces")
    by_task = cut.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n"))
    by_task = settle(by_task, "piece-counts")
    # At most ``capacity`` rows: the only thing that comes to the driver.
    counts = {r.length: r.n for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = slots(fill(counts, capacity))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    shift = by_task.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    ranked = cut.join(shift, ["length", "task"]).select("id", "piece", "start", "length", "crc", (F.col("rank") + F.col("shift")).alias("rank"))
    key = plan[:, 0] << 44 | plan[:, 1]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = np.asarray(batch.column(3)), np.asarray(batch.column(5))
            at = np.searchsorted(key, length << 44 | rank, "right") - 1
            _, first, many, base, offset = plan[at].T
            bin_, nth = np.divmod(rank - first, many)
            places = [pa.array(base + bin_), pa.array(offset + nth * length)]
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(5)] + places, names=[*range_names])

    range_names = (id_col, "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
    kind = docs.schema[id_col].dataType.simpleString()
    return ranked.mapInArrow(
        place, f"`{id_col}` {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    )
