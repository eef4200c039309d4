"""Removes long byte strings that occur more than once, by merging aligned suffix orders.

Every string of ``length`` bytes belongs to one anchor: the smallest hash of :data:`GRAM` bytes in it (the last of equals).
Equal strings have equal anchors at the same place, so only strings with the same anchor need to be compared, and those
of one occurrence lie side by side in one segment.  Occurrences of an anchor whose segments agree as a whole are repeated as
a whole.  What is left are segments that share an anchor but not all of their bytes.

These are compared by their Burrows-Wheeler orders.  Segments arrive in shards, one after the other; since
they are aligned at their anchors, the suffixes that begin at the same column form one order.  The interleave of the shards is
first their concatenation and is refined pass by pass: each pass takes one more column, from the last to the first, and
deals the rows stably by their symbol there, which turns the order of one column into that of the column before it without
sorting any suffix anew.  Common prefixes of neighbours follow from those of the pass before (one more than the least
between them, or nothing), and intervals with a common prefix of ``length`` bytes are the repeated strings.

Texts are UTF-8 bytes; nulls are empty; texts shorter than ``length`` have nothing to remove.  Rows that occur twice, id
included, repeat each other.  Strings are judged on the input, not on what is left.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.llm.store import settle
from panelspark.llm.words import Hasher, buffer_of, mix, ragged, slices

U = np.uint64
#: Bytes of an anchor.  Byte 255 occurs in no UTF-8 text and stands for what lies outside of a segment.
GRAM = 64
OUTSIDE = 255
#: Rows that are merged at once, and segments of one anchor up to which they are merged (see :func:`_by_strings`).
CHUNK, CROWD = 16_384, 8_192


def _last_least(h: np.ndarray, window: int) -> np.ndarray:
    """Place of the smallest value of every full window, the last of equals."""
    at, width = np.arange(len(h), dtype=np.int32), 1
    while width < window:
        step = min(width, window - width)
        later = h[step:] <= h[: len(h) - step]
        h, at = np.where(later, h[step:], h[: len(h) - step]), np.where(later, at[step:], at[: len(at) - step])
        width += step
    return at


def anchors(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Text, anchor hash, segment hash, anchor, first and last string start of all segments of a run of texts."""
    window = length - GRAM + 1
    if len(data) < length:
        return tuple(np.zeros(0, t) for t in (int, U, U, int, int, int))
    hasher = Hasher(data)
    every = np.arange(len(data) - GRAM + 1)
    h = hasher(every, every + GRAM)
    anchor = _last_least(h, window).astype(np.int64)
    of = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[: len(anchor)]
    start = np.flatnonzero(np.arange(len(anchor)) + length <= offsets[1:][of])
    anchor, of = anchor[start], of[start]
    first = np.flatnonzero(np.concatenate([[len(start) > 0], (anchor[1:] != anchor[:-1]) | (of[1:] != of[:-1])])) if len(start) else np.zeros(0, int)
    last = np.concatenate([first[1:], [len(start)]])[: len(first)] - 1
    a, b, p = start[first], start[last], anchor[first]
    segment = mix(hasher(a, b + length) ^ mix(((p - a) << 16 | (p - b)).astype(U)))
    return of[first], h[p], segment, p, a, b


def occurrences(texts: DataFrame, length: int) -> DataFrame:
    """(anchor, segment, doc, at) of all segments; ``texts`` has doc and text.

    ``at`` packs the anchor's place and how far before it the first and last string begin (the lowest two bytes).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc = np.asarray(batch.column(0))
            for first, _, d, o in slices(*buffer_of(batch.column(1))):
                of, h, segment, p, a, b = anchors(d, o, length)
                at = (p - o[of]) << 16 | (p - a) << 8 | (p - b)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h.view(np.int64)), pa.array(segment.view(np.int64)), pa.array(doc[first + of]), pa.array(at)], names=["anchor", "segment", "doc", "at"]
                )

    return texts.mapInArrow(run, "anchor long, segment long, doc long, at long")


def _span(length: int) -> list:
    """Start and end of a whole segment from ``at``."""
    place = F.shiftright("at", 16)
    return [
        (place - F.shiftright("at", 8).bitwiseAND(255)).cast("int").alias("start"),
        (place - F.col("at").bitwiseAND(255) + length).cast("int").alias("end"),
    ]


def merge(rows: np.ndarray, group: np.ndarray, length: int) -> np.ndarray:
    """Marks, for rows of bytes aligned at their anchors, the string starts whose string occurs in another row of the group.

    ``group`` is ascending.  Strings with an outside byte may be marked.
    """
    n, width = rows.shape
    starts = width - length + 1
    marks = np.zeros((n, starts), bool)
    order = np.arange(n)
    common = np.zeros(n + 1, np.int32)  # with the row before, from the current column on
    high = group.astype(np.int64) << 8
    for column in range(width - 1, -1, -1):
        key = high[order] | rows[order, column]
        deal = np.argsort(key, kind="stable")
        key = key[deal]
        i, j = deal[:-1], deal[1:]
        same = key[1:] == key[:-1]
        new = np.zeros(n + 1, np.int32)
        # Rows with the same symbol keep their order, so i < j for them.
        new[1:n] = np.where(same, common[j] + 1, 0)
        far = np.flatnonzero(same & (j != i + 1))
        if len(far):
            cuts = np.stack([i[far] + 1, j[far] + 1], axis=1).ravel()
            new[far + 1] = np.minimum.reduceat(common, cuts)[::2] + 1
        order, common = order[deal], new
        if column < starts:
            equal = common >= length
            marks[order[equal[:n] | equal[1:]], column] = True
    return marks


def _segments(texts: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """(anchor, doc, start, before, alone, bytes) of the segments ``wanted`` (doc, anchor, at, alone)."""
    of_doc = wanted.groupBy("doc").agg(F.collect_list(F.struct("anchor", "at", "alone")).alias("parts"))
    cut = texts.join(of_doc, "doc").select("doc", F.col("text").cast("binary").alias("text"), F.explode("parts").alias("part"))
    start, end = _span(length)
    cut = cut.select("doc", "text", "part.*").select("anchor", "doc", "alone", start, F.shiftright("at", 8).bitwiseAND(255).cast("int").alias("before"), end, "text")
    return cut.select("anchor", "doc", "start", "before", "alone", F.substring("text", F.col("start") + 1, F.col("end") - F.col("start")).alias("bytes"))


def _by_merge(segments: DataFrame, length: int) -> DataFrame:
    """(doc, start, end) of what is repeated in segments that are alone with their content."""
    before_most = length - GRAM
    width = before_most + length

    def work(part: list[np.ndarray], data: np.ndarray, at: np.ndarray) -> pa.RecordBatch:
        anchor, doc, start, before, alone = part
        size = np.diff(at)
        rows = np.full((len(doc), width), OUTSIDE, np.uint8)
        left = before_most - before
        rows.ravel()[ragged(np.arange(len(doc)) * width + left, size)] = data[at[0] : at[-1]]
        marks = merge(rows, np.cumsum(np.concatenate([[0], anchor[1:] != anchor[:-1]])), length)
        column = np.arange(marks.shape[1])
        marks &= (column >= left[:, None]) & (column + length <= (left + size)[:, None]) & alone[:, None]
        edge = np.diff(np.pad(marks, ((0, 0), (1, 1))).astype(np.int8), axis=1)
        row, a = np.nonzero(edge == 1)
        _, b = np.nonzero(edge == -1)
        shift = start[row] - left[row]
        return pa.RecordBatch.from_arrays(
            [pa.array(doc[row]), pa.array((a + shift).astype(np.int32)), pa.array((b - 1 + shift + length).astype(np.int32))], names=["doc", "start", "end"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        n = 0

        def flush(all_of_it: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held, n
            table = pa.Table.from_batches(held).combine_chunks()
            cols = [table.column(k).to_numpy() for k in range(5)]
            blob = table.column(5)
            data, at = buffer_of(blob)
            # Whole anchors only; the last one may go on in the next batch.
            new = np.flatnonzero(np.concatenate([[True], cols[0][1:] != cols[0][:-1]]))
            done = 0
            bounds = [*new[1:].tolist(), len(table)] if all_of_it else new[1:].tolist()
            for k, bound in enumerate(bounds):
                following = bounds[k + 1] if k + 1 < len(bounds) else None
                if following is None or following - done > CHUNK:
                    if bound > done:
                        yield work([c[done:bound] for c in cols], data, at[done : bound + 1])
                    done = bound
            held = table.slice(done).to_batches()
            n = len(table) - done

        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= CHUNK:
                yield from flush(False)
        if n:
            yield from flush(True)

    dealt = segments.repartition("anchor").sortWithinPartitions("anchor")
    return dealt.mapInArrow(run, "doc long, start int, end int")


def _by_strings(segments: DataFrame, length: int) -> DataFrame:
    """The same for anchors with more than CROWD different segments, which would be too much for one task.

    Every string of such a segment is dealt by its hash, so that a crowd of any size spreads.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = buffer_of(batch.column(5))
            anchor, doc, start, before, alone = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(5))
            many = np.diff(at) - length + 1
            row = np.repeat(np.arange(len(doc)), many)
            place = ragged(np.zeros(len(doc), np.int64), many)
            h = Hasher(data)(at[:-1][row] + place, at[:-1][row] + place + length)
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchor[row]), pa.array(h.view(np.int64)), pa.array(doc[row]), pa.array((start[row] + place).astype(np.int32)), pa.array(alone[row])],
                names=["anchor", "string", "doc", "start", "alone"],
            )

    strings = settle(segments.mapInArrow(run, "anchor long, string long, doc long, start int, alone boolean"), "crowded-strings")
    several = strings.groupBy("anchor", "string").count().filter("count > 1").select(F.expr("anchor ^ 0").alias("a"), F.expr("string ^ 0").alias("s"))
    found = strings.filter("alone").join(several, (F.col("anchor") == F.col("a")) & (F.col("string") == F.col("s")))
    return found.select("doc", "start", (F.col("start") + length).alias("end"))


def spans(texts: DataFrame, length: int, crowd: int = CROWD) -> DataFrame:
    """(doc, start, end): byte ranges whose strings all occur elsewhere; they may overlap.  ``texts`` has doc and text."""
    found = settle(occurrences(texts, length), "anchors")
    # Counted within tasks before the shuffle; a key that is an expression lets Spark split hot anchors in the joins.
    several = found.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"), F.min("segment").alias("a"), F.max("segment").alias("b")).filter("n > 1")
    several = several.select(F.expr("anchor ^ 0").alias("key"), (F.col("a") != F.col("b")).alias("mixed"))
    shared = settle(found.join(several, F.col("anchor") == F.col("key")).drop("key"), "shared-anchors")
    mixed = shared.filter("mixed")
    kinds = mixed.groupBy("anchor", "segment").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("doc", "at")).alias("one"))
    crowded = kinds.groupBy("anchor").count().select(F.expr("anchor ^ 0").alias("key"), (F.col("count") > crowd).alias("crowded"))
    kinds = settle(kinds.join(crowded, F.col("anchor") == F.col("key")).drop("key"), "segment-kinds")
    wanted = kinds.select("anchor", "one.*", (F.col("n") == 1).alias("alone"), "crowded")

    whole = [shared.filter("not mixed").select("doc", *_span(length))]
    copied = kinds.filter("n > 1").select(F.expr("anchor ^ 0").alias("a"), F.expr("segment ^ 0").alias("s"))
    whole.append(mixed.join(copied, (F.col("anchor") == F.col("a")) & (F.col("segment") == F.col("s"))).select("doc", *_span(length)))
    parts = settle(_by_merge(_segments(texts, wanted.filter("not crowded").drop("crowded"), length), length), "merged")
    whole.append(parts)
    if not kinds.filter("crowded").isEmpty():
        whole.append(_by_strings(_segments(texts, wanted.filter("crowded").drop("crowded"), length), length))
    out = whole[0]
    for more in whole[1:]:
        out = out.unionByName(more)
    return out


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 200, crowd: int = CROWD) -> DataFrame:
    """One row per input row: id, n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256, spans (start and end of each).

    A byte is removed if it lies in a string of ``length`` bytes (above 64, and at most 255 more) that also starts anywhere else.
    """
    if not GRAM < length <= GRAM + 255:
        raise ValueError("the length must lie between 65 and 319 bytes")
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    texts = texts.select("id", F.xxhash64("id", "text").alias("doc"), "text")
    kind = texts.schema["id"].dataType.simpleString()
    of_doc = settle(spans(texts.select("doc", "text"), length, crowd).groupBy("doc").agg(F.collect_list(F.struct("start", "end")).alias("found")), "repeat-spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = buffer_of(batch.column(1))
            found = batch.column(2)
            out: list[tuple] = []
            for k in range(batch.num_rows):
                own = data[at[k] : at[k + 1]]
                covered = np.zeros(len(own) + 1, np.int64)
                if found[k].is_valid:
                    values = found[k].values
                    np.add.at(covered, values.field("start").to_numpy(), 1)
                    np.add.at(covered, values.field("end").to_numpy(), -1)
                gone = np.cumsum(covered[:-1]) > 0
                edge = np.diff(np.concatenate([[0], gone.astype(np.int8), [0]]))
                runs = [{"start": a, "end": b} for a, b in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist())]
                out.append((len(own), int(gone.sum()), len(runs), hashlib.sha256(own[~gone].tobytes()).hexdigest(), runs))
            cols = [list(c) for c in zip(*out)] if out else [[]] * 5
            runs_kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), runs_kind)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(cols, kinds))], names=names)

    names = [id_col, "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"]
    both = texts.join(of_doc, "doc", "left").select("id", "text", "found")
    return both.mapInArrow(
        run, f"`{id_col}` {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start: int, end: int>>"
    )
