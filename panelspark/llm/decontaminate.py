"""Finds test items in training documents by spaced seeds, tolerant of substituted words.

Fixed masks pick some positions of a window of tokens and ignore the others; windows of a document and of an item that
agree on the picked tokens are a hit.  Around each hit the texts are compared along its diagonal: the stretch with the
best score (1 for an equal token, -2 for a substituted one) must hold enough equal tokens at a high enough share.

Tokens are runs of letters and digits in lower case, so changed case, punctuation or layout hide nothing.  Null and empty
texts match nothing; items with fewer tokens than ``least_tokens`` cannot be reported; repeated items and documents
are reported each.  Documents are never shuffled.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.llm.words import Hasher, buffer_of, code_points, find_words, mix, slices

U = np.uint64
#: 1: the token counts, 0: any token may stand there.  Each mask has five ones; between them they allow for a substitution anywhere.
MASKS = ("11111", "1101011", "11100101", "110010011")
#: Characters of test items that are searched for at once; more items are searched in several blocks.
BLOCK_CHARS = 16 << 20


@functools.cache
def _alnum() -> np.ndarray:
    return np.fromiter((chr(i).isalnum() for i in range(0x110000)), bool, 0x110000)


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the tokens of a run of (lower-cased) texts, and the bounds of each text among them."""
    points, at = code_points(data, offsets)
    words = find_words(points, at, _alnum()[points])
    with np.errstate(over="ignore"):
        code = mix(points.astype(U) * U(0x9E3779B97F4A7C15)) | U(1)
    return Hasher(points, code)(words.start, words.end), words.bounds


def seeds(tok: np.ndarray, bounds: np.ndarray, mask: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of a mask at every window that lies in one text, and where each window starts."""
    ones = [i for i, c in enumerate(MASKS[mask]) if c == "1"]
    span = len(MASKS[mask])
    fits = np.zeros(len(tok), bool)
    sizes = np.diff(bounds)
    left = np.repeat(bounds[1:], sizes) - np.arange(bounds[0], bounds[-1])
    fits[bounds[0] : bounds[-1]] = left >= span
    at = np.flatnonzero(fits)
    h = np.full(len(at), U(mask + 1))
    with np.errstate(over="ignore"):
        for i in ones:
            h = (h ^ tok[at + i]) * U(0x9FB21C651E98DF25)
            h ^= h >> U(29)
    return mix(h), at


@dataclass
class Items:
    """A block of test items with its seeds, sorted by hash."""

    ids: pa.Array
    tok: np.ndarray
    bounds: np.ndarray
    seed: np.ndarray
    item: np.ndarray
    at: np.ndarray
    likely: np.ndarray

    @staticmethod
    def of(ids: pa.Array, texts: pa.Array) -> Items:
        tok, bounds = tokens(*buffer_of(texts))
        found = [seeds(tok, bounds, m) for m in range(len(MASKS))]
        seed, at = np.concatenate([h for h, _ in found]), np.concatenate([a for _, a in found])
        order = np.argsort(seed, kind="stable")
        likely = np.zeros(1 << 20, bool)
        likely[(seed >> U(44)).astype(np.int64)] = True
        item = np.searchsorted(bounds, at, "right") - 1
        return Items(ids, tok, bounds, seed[order], item[order], (at - bounds[item])[order], likely)


def best_stretch(same: np.ndarray) -> tuple[int, int]:
    """Start and end of the stretch of largest score (1 where equal, -2 elsewhere); the first and shortest of equals."""
    total = np.concatenate([[0], np.cumsum(np.where(same, 1, -2))])
    lowest = np.minimum.accumulate(total)
    end = int(np.argmax(total - lowest))
    return int(np.flatnonzero(total[: end + 1] == lowest[end])[-1]), end


def overlaps(items: Items, data: np.ndarray, offsets: np.ndarray, least_tokens: int, least_share: float) -> list[tuple[int, ...]]:
    """(text, item, matched, start, end, item start, item end) in tokens: the best overlap of each pair, in order."""
    tok, bounds = tokens(data, offsets)
    hits = set()
    for mask in range(len(MASKS)):
        h, at = seeds(tok, bounds, mask)
        maybe = np.flatnonzero(items.likely[(h >> U(44)).astype(np.int64)])
        h, at = h[maybe], at[maybe]
        lo, hi = np.searchsorted(items.seed, h), np.searchsorted(items.seed, h, "right")
        real = np.flatnonzero(hi > lo)
        text = np.searchsorted(bounds, at[real], "right") - 1
        for t, p, a, b in zip(text.tolist(), (at[real] - bounds[text]).tolist(), lo[real].tolist(), hi[real].tolist()):
            hits.update(zip([t] * (b - a), items.item[a:b].tolist(), (p - items.at[a:b]).tolist()))
    best: dict[tuple[int, int], tuple[int, ...]] = {}
    for t, i, shift in sorted(hits):
        own, test = tok[bounds[t] : bounds[t + 1]], items.tok[items.bounds[i] : items.bounds[i + 1]]
        a, b = max(0, -shift), min(len(test), len(own) - shift)
        same = own[a + shift : b + shift] == test[a:b]
        start, end = best_stretch(same)
        matched = int(same[start:end].sum())
        if matched >= least_tokens and matched >= least_share * (end - start) and matched > best.get((t, i), (0,))[0]:
            best[t, i] = (matched, a + shift + start, a + shift + end, a + start, a + end)
    return [(t, i, *found) for (t, i), found in sorted(best.items())]


def blocks(benchmark: DataFrame, id_col: str, text_col: str, block_chars: int) -> Iterator[Items]:
    """The items in blocks of about ``block_chars`` characters (a longer item is a block of its own at most)."""
    rows = benchmark.select(F.col(id_col).alias("id"), F.lower(text_col).alias("text")).filter("text is not null")
    chars = rows.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    n = -(-chars // block_chars)
    for k in range(n):
        part = rows.filter(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == k).orderBy("id", "text").toArrow()
        if part.num_rows:
            yield Items.of(part.column(0).combine_chunks(), part.column(1))


def found_in(spark: SparkSession, text: Column | str, items: Items, least_tokens: int, least_share: float) -> Column:
    """Array of structs (item, matched, start, end, item_start, item_end, item_tokens): the items of a block in a text."""
    shared = spark.sparkContext.broadcast(items)
    names = ["matched", "start", "end", "item_start", "item_end", "item_tokens"]
    id_kind = "long" if pa.types.is_integer(items.ids.type) else "string"
    kinds = ", ".join(f"{n}: int" for n in names)

    @F.arrow_udf(f"array<struct<item: {id_kind}, {kinds}>>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        block = shared.value
        ids = block.ids.cast(pa.int64() if id_kind == "long" else pa.string())
        for batch in batches:
            rows = [
                (first + r[0], *r[1:])
                for first, _, d, o in slices(*buffer_of(batch))
                for r in overlaps(block, d, o, least_tokens, least_share)
            ]
            cols = np.array(rows, np.int64).reshape(-1, 7)
            size = np.diff(block.bounds)[cols[:, 1]]
            values = [ids.take(pa.array(cols[:, 1]))] + [pa.array(v.astype(np.int32)) for v in (*cols[:, 2:].T, size)]
            at = np.concatenate([[0], np.cumsum(np.bincount(cols[:, 0], minlength=len(batch)))]).astype(np.int32)
            yield pa.ListArray.from_arrays(pa.array(at), pa.StructArray.from_arrays(values, names=["item", *names]))

    return run(F.lower(text))


def contaminated(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id",
    item_text: str = "text", least_tokens: int = 10, least_share: float = 0.8, block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """One row per document and item found in it: id, item id, matched tokens, its place in both, identity and coverage.

    ``start`` to ``end`` are token positions in the document, ``item_start`` to ``item_end`` in the item; ``identity`` is the
    share of equal tokens in the stretch, ``coverage`` the share of the item's tokens that matched.
    """
    spark, all_found = docs.sparkSession, None
    for items in blocks(benchmark, item_id, item_text, block_chars):
        hit = docs.select(F.col(id_col), F.explode(found_in(spark, text_col, items, least_tokens, least_share)).alias("_hit"))
        rows = hit.select(
            id_col, F.col("_hit.item").alias(item_id), *[F.col(f"_hit.{c}") for c in ("matched", "start", "end", "item_start", "item_end")],
            (F.col("_hit.matched") / (F.col("_hit.end") - F.col("_hit.start"))).alias("identity"),
            (F.col("_hit.matched") / F.col("_hit.item_tokens")).alias("coverage"),
        )
        all_found = rows if all_found is None else all_found.unionByName(rows)
    if all_found is None:
        kinds = f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, `{item_id}` {benchmark.schema[item_id].dataType.simpleString()}"
        return spark.createDataFrame([], kinds + ", matched int, start int, end int, item_start int, item_end int, identity double, coverage double")
    return all_found


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text",
    least_tokens: int = 10, least_share: float = 0.8, block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """``docs`` without the documents in which an item is found."""
    spark = docs.sparkSession
    left = docs.select(F.struct(*docs.columns).alias("doc"))
    for items in blocks(benchmark, item_id, item_text, block_chars):
        left = left.filter(F.size(found_in(spark, F.col("doc")[text_col], items, least_tokens, least_share)) == 0)
    return left.select("doc.*")
