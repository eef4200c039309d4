"""Toxicity by a chain of classifiers: later linear models see the probabilities of earlier categories.

Features are hashed words and word beginnings, weighted by log(1 + count) and rarity and scaled to length one.  While training, an earlier
category's probability of a row comes from a model that has not seen this row (out of fold), so later models learn
how far it can be trusted; for prediction each category has one model fitted on all training rows.

All models of a category, the one on all rows and one for each fold, are fitted together: each step goes over the rows once and
adds up the losses and slopes of all of them in the tasks, so the driver gets one vector from each of a fixed number of partitions.

Null and empty texts have no feature and get the probability of the intercept.  Rows with a null label are not learnt from;
repeated rows count as often as they occur.  A category that has one value only in training gets that value as probability.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelspark.llm.store import settle
from panelspark.llm.words import Hasher, buffer_of, code_points, find_words, mix, slices

U = np.uint64
#: Letters of a word beginning.
BEGINNING = 5
#: Partitions of the training rows while they are fitted: few, as each sends a vector of all weights, and rows are bounded by the sample.
PARTS = 3


@functools.cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def features(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, index and log(1 + count) of the features of a run of (lower-cased) texts, sorted by the first two."""
    points, at = code_points(data, offsets)
    words = find_words(points, at, _letters()[points])
    with np.errstate(over="ignore"):
        hasher = Hasher(points, mix(points.astype(U) * U(0x9E3779B97F4A7C15)) | U(1))
    long = words.end - words.start >= BEGINNING
    begins = hasher(words.start[long], words.start[long] + BEGINNING)
    of = words.text_of()
    index = np.concatenate([hasher(words.start, words.end), mix(begins)]) % U(size)
    key, count = np.unique(np.concatenate([of, of[long]]) * size + index.astype(np.int64), return_counts=True)
    return key // size, key % size, np.log1p(count)


def scaled(text: np.ndarray, index: np.ndarray, value: np.ndarray, rarity: np.ndarray, n_texts: int) -> np.ndarray:
    """Values weighted by the rarity of their features, each text scaled to length one."""
    value = value * rarity[index]
    length = np.sqrt(np.bincount(text, value * value, n_texts))
    return value / np.maximum(length, 1e-9)[text]


@dataclass
class Chain:
    """Weights of each category in order: one for each feature, one for each earlier category, and the intercept.

    ``place`` gives the number of a hashed feature among those with weights, or -1; ``rarity`` goes by that number.
    ``thresholds`` are the probabilities from which a category is best taken for given.
    """

    labels: list[str]
    place: np.ndarray
    rarity: np.ndarray
    weights: list[np.ndarray] = field(default_factory=list)
    earlier: list[np.ndarray] = field(default_factory=list)
    intercepts: list[float] = field(default_factory=list)
    thresholds: list[float] = field(default_factory=list)

    def known(self, text: np.ndarray, index: np.ndarray, value: np.ndarray, n_texts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, number and scaled value of the features that have weights."""
        place = self.place[index]
        kept = place >= 0
        return text[kept], place[kept], scaled(text[kept], place[kept], value[kept], self.rarity, n_texts)


def _counted(rows: DataFrame, size: int, labels: Sequence[str]) -> DataFrame:
    """(key, y0, …, index, value): the training rows with their unscaled features."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            index, value, sizes = [np.zeros(0, int)], [np.zeros(0)], [np.zeros(0, int)]
            for first, end, d, o in slices(*buffer_of(batch.column(1))):
                text, i, v = features(d, o, size)
                index.append(i)
                value.append(v)
                sizes.append(np.bincount(text, minlength=end - first))
            at = pa.array(np.concatenate([[0], np.cumsum(np.concatenate(sizes))]).astype(np.int32))
            lists = [pa.ListArray.from_arrays(at, pa.array(np.concatenate(x))) for x in (index, value)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *batch.columns[2:], lists[0].cast(pa.list_(pa.int32())), lists[1]],
                names=["key", *[f"y{k}" for k in range(len(labels))], "index", "value"],
            )

    ys = ", ".join(f"y{k} double" for k in range(len(labels)))
    return rows.mapInArrow(run, f"key long, {ys}, index array<int>, value array<double>")


def _numbered(counted: DataFrame, size: int, least_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of the features of at least ``least_rows`` training rows (-1: of fewer, nothing can be learnt), and the log of their rarity."""
    n = counted.count()
    seen = counted.select(F.explode("index").alias("index")).groupBy("index").count().filter(F.col("count") >= least_rows).toArrow()
    index, count = seen.column(0).to_numpy(), seen.column(1).to_numpy()
    order = np.argsort(index)
    place = np.full(size, -1, np.int32)
    place[index[order]] = np.arange(len(index))
    return place, np.log((n + 1) / count[order])


def _lists(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, index and value of the features of a batch; columns ``index`` and ``value``."""
    index, value = batch.column("index"), batch.column("value")
    row = np.repeat(np.arange(batch.num_rows), index.value_lengths().to_numpy())
    return row, index.flatten().to_numpy().astype(np.int64), value.flatten().to_numpy()


def _inputs(counted: DataFrame, chain: Chain) -> DataFrame:
    """The training rows with the numbers of their features and the scaled values."""
    shared = counted.sparkSession.sparkContext.broadcast(chain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, index, value = shared.value.known(*_lists(batch), batch.num_rows)
            at = pa.array(np.concatenate([[0], np.cumsum(np.bincount(row, minlength=batch.num_rows))]).astype(np.int32))
            lists = [pa.ListArray.from_arrays(at, pa.array(x)) for x in (index.astype(np.int32), value)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], *lists], names=batch.schema.names)

    return counted.mapInArrow(run, counted.schema)


def train(
    docs: DataFrame, labels: DataFrame, chain: Sequence[str], id_col: str = "doc_id", text_col: str = "text",
    size: int = 1 << 17, folds: int = 3, sample: int = 20_000, penalty: float = 1e-6, least_rows: int = 4,
) -> Chain:
    """Fits the categories ``chain`` (columns of ``labels`` with 0 and 1) in this order.

    It learns from about ``sample`` labelled rows at most, chosen by a hash of their ids; this bounds the time of the fits, and it is
    the only place where not all rows count.
    """
    known = labels.select(F.col(id_col).alias("_id"), *[F.col(c).cast("double").alias(f"_y{k}") for k, c in enumerate(chain)]).dropna()
    share = min(1.0, sample / max(1, known.count()))
    known = known.filter(F.pmod(F.xxhash64("_id", F.lit("sample")), F.lit(1 << 30)) < int(share * (1 << 30)))
    # The sample has a proven bound, so the documents need not move to meet it.
    rows = docs.select(F.col(id_col).alias("_id"), F.lower(text_col).alias("text")).join(F.broadcast(known), "_id")
    counted = settle(_counted(rows.select(F.xxhash64("_id").alias("key"), "text", *[f"_y{k}" for k in range(len(chain))]), size, chain), "toxic-rows")
    found = Chain(list(chain), *_numbered(counted, size, least_rows))
    data = settle(_inputs(counted, found), "toxic-inputs")
    for k in range(len(chain)):
        # Fits go over the rows many times: a few partitions in memory, which Spark builds anew if they are lost.
        rows = data.coalesce(PARTS).persist()
        fitted = _fit(rows, k, len(found.rarity), folds, penalty)
        found.weights.append(fitted[folds, : len(found.rarity)])
        found.earlier.append(fitted[folds, len(found.rarity) : -1])
        found.intercepts.append(float(fitted[folds, -1]))
        data = settle(_out_of_fold(rows, k, fitted[:folds]), "toxic-folds")
        rows.unpersist()
        # As many rows as the sample has.
        judged = data.select(f"y{k}", f"p{k}").toArrow()
        found.thresholds.append(best_threshold(judged.column(0).to_numpy(), judged.column(1).to_numpy()))
    return found


def best_threshold(truth: np.ndarray, probability: np.ndarray) -> float:
    """The probability that separates best (by F1), half way to the next lower one; 0.5 if there is nothing to separate."""
    if not len(truth) or truth.min() == truth.max():
        return 0.5
    order = np.argsort(-probability, kind="stable")
    hit, p = np.cumsum(truth[order]), probability[order]
    f1 = 2 * hit / (np.arange(1, len(p) + 1) + truth.sum())
    last = np.append(p[1:] < p[:-1], True)  # equal probabilities are on the same side
    best = int(np.argmax(np.where(last, f1, -1)))
    return float((p[best] + (p[best + 1] if best + 1 < len(p) else 0)) / 2)


def logistic(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def _margins(batch: pa.RecordBatch, k: int, weights: np.ndarray) -> np.ndarray:
    """The margin of each row by each model (a row of ``weights``: features, ``k`` earlier probabilities, intercept)."""
    row, index, value = _lists(batch)
    earlier = np.array([batch.column(f"p{i}").to_numpy() for i in range(k)]).reshape(k, batch.num_rows)
    n = weights.shape[1] - k - 1
    found = [np.bincount(row, w[index] * value, batch.num_rows) + w[n : n + k] @ earlier + w[-1] for w in weights]
    return np.array(found).reshape(len(weights), batch.num_rows)


def _slopes(rows: DataFrame, k: int, folds: int, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum of losses and of their slopes, of each model over its rows: the first ``folds`` leave their fold out."""
    shared = rows.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        n = w.shape[1] - k - 1
        loss, slope = np.zeros(len(w)), np.zeros(w.shape)
        for batch in batches:
            row, index, value = _lists(batch)
            y, fold = batch.column(f"y{k}").to_numpy(), batch.column("key").to_numpy() % folds
            z = _margins(batch, k, w)
            for m in range(len(w)):
                mine = fold != m
                loss[m] += (np.logaddexp(0, z[m]) - y * z[m])[mine].sum()
                off = np.where(mine, logistic(z[m]) - y, 0.0)
                slope[m, :n] += np.bincount(index, off[row] * value, n)
                for i in range(k):
                    slope[m, n + i] += off @ batch.column(f"p{i}").to_numpy()
                slope[m, -1] += off.sum()
        yield pa.RecordBatch.from_arrays([pa.array([np.concatenate([loss, slope.ravel()]).tobytes()])], names=["sums"])

    total = sum(np.frombuffer(x.as_py()) for x in rows.mapInArrow(run, "sums binary").toArrow().column(0))
    shared.destroy()
    return total[: len(weights)], total[len(weights) :].reshape(weights.shape)


class Descent:
    """Limited-memory quasi-Newton descent of one function, which is evaluated elsewhere: ``trial`` is where, ``tell`` takes the answer."""

    def __init__(self, start: np.ndarray, memory: int = 10, tolerance: float = 1e-7) -> None:
        self.trial, self.at, self.done = start, start, False
        self._value, self._memory, self._tolerance, self._past = np.inf, memory, tolerance, []

    def tell(self, value: float, slope: np.ndarray) -> None:
        if np.isinf(self._value):
            self._value, self._slope = value, slope
            return self._turn()
        if value > self._value + 1e-4 * self._step * (self._way @ self._slope):
            self._step /= 4
            self.done = self._step < 1e-8
        else:
            moved, bent, gain = self.trial - self.at, slope - self._slope, self._value - value
            if moved @ bent > 1e-12 * (bent @ bent):
                self._past = [*self._past, (moved, bent)][-self._memory :]
            self.at, self._value, self._slope = self.trial, value, slope
            self.done = gain <= self._tolerance * max(abs(value), 1e-6)
            return self._turn()
        self.trial = self.at + self._step * self._way

    def _turn(self) -> None:
        """A new direction by the last moves, at first the steepest one."""
        way, parts = self._slope.copy(), []
        for moved, bent in reversed(self._past):
            parts.append((moved @ way) / (moved @ bent))
            way -= parts[-1] * bent
        if self._past:
            moved, bent = self._past[-1]
            way *= (moved @ bent) / (bent @ bent)
        for (moved, bent), part in zip(self._past, reversed(parts)):
            way += (part - (bent @ way) / (moved @ bent)) * moved
        self._way = -way
        length = float(np.sqrt(self._slope @ self._slope))
        self._step = 1.0 if self._past else 1 / max(length, 1.0)
        self.done = self.done or length < 1e-9
        self.trial = self.at + self._step * self._way


def descend(starts: np.ndarray, evaluate: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]], passes: int) -> np.ndarray:
    """Minimises several functions at once; ``evaluate`` gives values and slopes of all of them, at one place each."""
    each = [Descent(start) for start in starts]
    for _ in range(passes):
        if all(one.done for one in each):
            break
        values, slopes = evaluate(np.array([one.trial for one in each]))
        for one, value, slope in zip(each, values, slopes):
            if not one.done:
                one.tell(value, slope)
    return np.array([one.at for one in each])


def _fit(rows: DataFrame, k: int, n_features: int, folds: int, penalty: float, passes: int = 40) -> np.ndarray:
    """Weights of category ``k``: a model without each fold, then the model on all rows.

    The mean loss plus ``penalty`` / 2 times the squared weights is minimised, in at most ``passes`` passes over the rows.  A model whose rows have one value only is constant.
    """
    seen = {r.fold: (r.n, r.given) for r in rows.groupBy(F.pmod("key", F.lit(folds)).alias("fold")).agg(F.count("*").alias("n"), F.sum(f"y{k}").alias("given")).collect()}
    n, given = (np.array([seen.get(fold, (0, 0.0))[i] for fold in range(folds)], float) for i in range(2))
    n, given = (np.append(x.sum() - x, x.sum()) for x in (n, given))
    both = (given > 0) & (given < n)
    start = np.zeros((folds + 1, n_features + k + 1))
    start[:, -1] = np.where(given > 0, 50.0, -50.0)
    start[both, -1] = np.log(given[both] / (n[both] - given[both]))
    if not both.any():
        return start
    weighed = np.append(np.ones(n_features + k), 0.0)

    def evaluate(weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        loss, slope = _slopes(rows, k, folds, weights)
        of = np.maximum(n, 1)
        loss, slope = loss / of + penalty / 2 * (weights**2 @ weighed), slope / of[:, None] + penalty * weights * weighed
        return loss, np.where(both[:, None], slope, 0.0)

    return descend(start, evaluate, passes)


def _out_of_fold(rows: DataFrame, k: int, weights: np.ndarray) -> DataFrame:
    """The rows with the probability ``p{k}`` by the model that has not seen their fold."""
    shared = rows.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fold = batch.column("key").to_numpy() % len(weights)
            p = logistic(_margins(batch, k, shared.value)[fold, np.arange(batch.num_rows)])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(p)], names=[*batch.schema.names, f"p{k}"])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField(f"p{k}", T.DoubleType())]))


def probabilities(spark: SparkSession, chain: Chain, text: Column | str) -> Column:
    """Struct with the probability of each category of a text, in chain order."""
    shared = spark.sparkContext.broadcast(chain)
    fields = [pa.field(f"p{k}", pa.float64()) for k in range(len(chain.labels))]

    @F.arrow_udf("struct<" + ", ".join(f"p{k}: double" for k in range(len(chain.labels))) + ">")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        c = shared.value
        for batch in batches:
            done = [np.zeros((0, len(c.labels)))]
            for first, end, d, o in slices(*buffer_of(batch)):
                text, index, value = c.known(*features(d, o, len(c.place)), end - first)
                p = np.zeros((end - first, len(c.labels)))
                for k in range(len(c.labels)):
                    z = np.bincount(text, c.weights[k][index] * value, end - first) + c.intercepts[k] + p[:, :k] @ c.earlier[k]
                    p[:, k] = logistic(z)
                done.append(p)
            all_p = np.concatenate(done)
            yield pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(all_p[:, k])) for k in range(len(fields))], fields=fields)

    return run(F.lower(text))


def predict(docs: DataFrame, chain: Chain, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, and for each category ``<label>`` (boolean) and ``<label>_probability``.

    A category is given from the probability on that separated best among training rows judged out of fold.
    """
    found = docs.select(F.col(id_col), probabilities(docs.sparkSession, chain, text_col).alias("_p"))
    each = [(F.col(f"_p.p{k}"), label, chain.thresholds[k]) for k, label in enumerate(chain.labels)]
    return found.select(id_col, *[c for p, label, at in each for c in ((p >= at).alias(label), p.alias(f"{label}_probability"))])
