"""Language of a text by words first: log frequencies of known words, and character n-grams for the others.

Training counts, over all labelled texts, the words of every language and the character n-grams of these words.  A text is
scored word by word: a known word by its log frequency in each language; an unseen one by the mean over its longest known
n-grams, from four characters down to one.  The language with the largest sum wins, ties go to the first in order.

Words are maximal runs of letters in lower case.  Null texts and texts without a letter are ``und`` with score 0, and so are all
if there is nothing to learn from.  Repeated rows count as often as they occur; rows with a null language teach nothing.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelspark.llm.store import settle
from panelspark.llm.words import Hasher, Tally, Words, buffer_of, code_points, find_words, lookup, mix, ragged, slices

UNKNOWN = "und"
#: Longest n-gram.  Order 0 stands for whole words.
LONGEST = 4
U = np.uint64


@functools.cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[Words, Hasher]:
    points, at = code_points(data, offsets)
    with np.errstate(over="ignore"):
        code = mix(points.astype(U) * U(0x9E3779B97F4A7C15)) | U(1)
    return find_words(points, at, _letters()[points]), Hasher(points, code)


def _grams(hasher: Hasher, start: np.ndarray, end: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all n-grams of some words, and the word that each belongs to."""
    many = np.maximum(end - start - order + 1, 0)
    at = ragged(start, many)
    return hasher(at, at + order), np.repeat(np.arange(len(start)), many)


def counts(docs: DataFrame, languages: list[str], text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, order, key, n): occurrences of each word (order 0) and n-gram, by 64-bit hash; lang is a place in ``languages``."""
    place = {lang: i for i, lang in enumerate(languages)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tallies: dict[tuple[int, int], Tally] = {}
        for batch in batches:
            lang = np.array([place[x] for x in batch.column(1).to_pylist()], np.int64)
            data, offsets = buffer_of(batch.column(0))
            for first, _, d, o in slices(data, offsets):
                words, hasher = _words(d, o)
                of = lang[first + words.text_of()]
                key = hasher(words.start, words.end)
                for i in np.unique(of).tolist():
                    mine = np.flatnonzero(of == i)
                    keys, at, n = np.unique(key[mine], return_index=True, return_counts=True)
                    tallies.setdefault((i, 0), Tally()).add(keys, n)
                    at = mine[at]
                    for order in range(1, LONGEST + 1):
                        grams, word = _grams(hasher, words.start[at], words.end[at], order)
                        one = Tally()
                        one.add(grams, n[word])
                        tallies.setdefault((i, order), Tally()).add(*one.total())
        for (i, order), tally in tallies.items():
            keys, n = tally.total()
            for a in range(0, len(keys), 1 << 16):
                k = keys[a : a + (1 << 16)]
                fixed = [pa.array(np.full(len(k), v, np.int32)) for v in (i, order)]
                yield pa.RecordBatch.from_arrays(
                    [*fixed, pa.array(k.view(np.int64)), pa.array(n[a : a + (1 << 16)])], names=["lang", "order", "key", "n"]
                )

    rows = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.lower(text_col).alias("text"), F.col(lang_col).alias("lang"))
    found = rows.mapInArrow(run, "lang int, order int, key long, n long")
    return found.groupBy("lang", "order", "key").agg(F.sum("n").alias("n"))


@dataclass
class Model:
    """Log frequencies: for each order the sorted keys, and a row of one value per language for each."""

    languages: list[str]
    tables: list[tuple[np.ndarray, np.ndarray]]


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", words: int = 65_536, grams: int = 32_768, smoothing: float = 0.5) -> Model:
    """Learns from all rows with a language.

    The model holds, for each language, its most frequent words (at most ``words``) and n-grams (at most ``grams`` of each
    length), which bounds what is collected and broadcast; ties at the border are left out together.  What one language keeps has
    its counts in all languages.  Frequencies are relative to all that was counted.
    """
    languages = sorted(r[0] for r in docs.select(lang_col).filter(F.col(lang_col).isNotNull()).distinct().collect())
    if not languages:
        return Model([], [])
    counted = settle(counts(docs, languages, text_col, lang_col), "language-counts")
    totals = {(r.lang, r.order): r.total for r in counted.groupBy("lang", "order").agg(F.sum("n").alias("total")).collect()}
    # How many keys have so many occurrences or more; the histogram is small, so no large sort is needed.
    histogram = counted.groupBy("lang", "order", "n").agg(F.count(F.lit(1)).alias("keys"))
    above = F.sum("keys").over(Window.partitionBy("lang", "order").orderBy(F.desc("n")))
    least = histogram.withColumn("above", above).filter(F.col("above") <= F.when(F.col("order") == 0, words).otherwise(grams))
    least = least.groupBy("lang", "order").agg(F.min("n").alias("least"))
    frequent = counted.join(F.broadcast(least), ["lang", "order"]).filter("n >= least").select("order", "key").distinct()
    # A key that one language keeps has the counts of all languages, also where they lie below the border.
    kept = counted.join(frequent, ["order", "key"]).select("lang", "order", "key", "n").toArrow()
    lang, order, key, n = (kept.column(i).to_numpy() for i in range(4))
    tables = []
    for k in range(LONGEST + 1):
        mine = order == k
        keys, at = np.unique(key[mine].view(U), return_inverse=True)
        seen = np.zeros((len(keys), len(languages)))
        seen[at, lang[mine]] = n[mine]
        total = np.array([totals.get((i, k), 0) for i in range(len(languages))], float)
        tables.append((keys, np.log((seen + smoothing) / (total + smoothing * (len(keys) + 1))).astype(np.float32)))
    return Model(languages, tables)


def _score(model: Model, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each text the best language's place (-1: no letter) and its share of the probability."""
    words, hasher = _words(data, offsets)
    n_texts = len(offsets) - 1
    place, share = np.full(n_texts, -1), np.zeros(n_texts)
    if not len(words.start):
        return place, share
    keys, first, of = np.unique(hasher(words.start, words.end), return_index=True, return_inverse=True)
    value = np.zeros((len(keys), len(model.languages)))
    at = lookup(model.tables[0][0], keys)
    value[at >= 0] = model.tables[0][1][at[at >= 0]]
    unseen = np.flatnonzero(at < 0)
    for order in range(LONGEST, 0, -1):
        if not len(unseen):
            break
        table, logs = model.tables[order]
        grams, word = _grams(hasher, words.start[first[unseen]], words.end[first[unseen]], order)
        at = lookup(table, grams)
        word, at = word[at >= 0], at[at >= 0]
        found = np.bincount(word, minlength=len(unseen))
        for i in range(value.shape[1]):
            value[unseen, i] = np.bincount(word, logs[at, i], len(unseen)) / np.maximum(found, 1)
        unseen = unseen[found == 0]
    sums = np.concatenate([np.zeros((1, value.shape[1])), np.cumsum(value[of], axis=0)])
    logs = np.diff(sums[words.bounds], axis=0)
    some = words.per_text() > 0
    place[some] = logs[some].argmax(axis=1)
    share[some] = 1 / np.exp(np.minimum(logs[some] - logs[some].max(axis=1, keepdims=True), 0)).sum(axis=1)
    return place, share


def language(spark: SparkSession, model: Model, text: Column | str) -> Column:
    """Struct (lang, score) of a text; the model is broadcast, its size bounded by :func:`train`."""
    shared = spark.sparkContext.broadcast(model)
    kind = pa.struct([("lang", pa.string()), ("score", pa.float64())])

    @F.arrow_udf("struct<lang: string, score: double>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = shared.value
        names = np.array([*known.languages, UNKNOWN], object)
        for batch in batches:
            parts = []
            for first, end, d, o in slices(*buffer_of(batch)):
                parts.append(_score(known, d, o) if known.languages else (np.full(end - first, -1), np.zeros(end - first)))
            place, share = (np.concatenate(x) for x in zip(*parts)) if parts else (np.zeros(0, int), np.zeros(0))
            yield pa.StructArray.from_arrays([pa.array(names[place].tolist(), pa.string()), pa.array(share)], fields=[*kind])

    return run(F.lower(text))


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, lang_pred, score."""
    found = docs.select(F.col(id_col), language(docs.sparkSession, model, text_col).alias("_found"))
    return found.select(id_col, F.col("_found.lang").alias("lang_pred"), F.col("_found.score").alias("score"))


def drop_unknown(docs: DataFrame, model: Model, text_col: str = "text", above: float | None = None) -> DataFrame:
    """``docs`` without the texts whose language is unknown, or whose score is not above ``above``.

    By default that is the share of each language by chance: only texts that tell nothing about their language go.
    """
    if above is None:
        above = 1 / len(model.languages) + 1e-6 if len(model.languages) > 1 else 0.0
    both = docs.select(F.struct(*docs.columns).alias("doc"), language(docs.sparkSession, model, text_col).alias("found"))
    return both.filter((F.col("found.lang") != UNKNOWN) & (F.col("found.score") > above)).select("doc.*")
