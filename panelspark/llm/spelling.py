"""Groups of spelling variants: words that differ by one letter, by a bit-sliced position index.

A block of the index holds, for every place and letter, the set of its words with that letter there, as bits.  A word is looked up
in all words of a block at once: sets of words that agree so far, or with one letter replaced, left out or put in, are advanced
letter by letter with the bits of this place and of the places beside it, 64 words of the block in one operation.

Of two words one letter apart, the shorter having m letters, the first half of m or the last half of m agrees.  So words are dealt
by these halves, and a block holds words that share one, of one length or of two neighbouring ones.  A half that very many words
share is cut into blocks, and its words are looked up in each of them, in different tasks.  No pair is left out.

Null texts have no words, a null id counts as an empty one.  Rows that occur twice count twice.  Ties between forms go to the word
that is least in code-point order.  Texts of any length are read whole; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain, groupby, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.llm.store import settle

RUNS = r"[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Words of a block of the index, at most; and of a half that is not cut, about.
BLOCK, SHARE = 1024, 8192


def runs_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", slip: int = 199, least_length: int = 6) -> DataFrame:
    """(word): every run of so many letters at least, A-Z in lower case; where ``slip`` divides crc32(``id:run``) one letter is left out."""
    runs = docs.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("_id"),
        F.explode(F.regexp_extract_all(F.translate(F.col(text_col), UPPER, LOWER), F.lit(RUNS), F.lit(0))).alias("run"),
    )
    runs = runs.filter(F.length("run") >= least_length)
    hashed = F.crc32(F.concat("_id", F.lit(":"), "run").cast("binary"))
    at = (hashed % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    return runs.select(F.when(hashed % slip == 0, cut).otherwise(F.col("run")).alias("word"))


def vocabulary(words: DataFrame, least_length: int = 6, least_count: int = 5) -> DataFrame:
    """(word, n): words of so many code points at least that occur so often at least."""
    counted = words.filter(F.length("word") >= least_length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.filter(F.col("n") >= least_count)


def _dealt(words: DataFrame, share: int) -> DataFrame:
    """(key, listed, word, n, size, mixed, end) of the halves by which a word can meet others; every row asks, and some are listed.

    ``size`` is the length of the shorter words of the key, ``mixed`` tells that those of one letter more are meant to meet them, and
    ``end`` a last half.
    """
    size, half = F.length("word"), lambda m: F.floor(m / 2).cast("int")
    # Pairs of equal length, this word the shorter one, this word the longer one.
    kinds = F.array(*[F.struct(m.alias("size"), F.lit(mixed).alias("mixed")) for m, mixed in ((size, False), (size, True), (size - 1, True))])
    ends = F.explode(F.array(F.lit(False), F.lit(True)))
    rows = words.select("word", "n", F.explode(kinds).alias("k")).select("word", "n", "k.*", ends.alias("end"))
    # Of m letters the first floor(m / 2) or the last m - floor(m / 2) agree, whether one is replaced or one more put in.
    first = half(F.col("size"))
    part = F.when(F.col("end"), F.expr("right(word, size - cast(floor(size / 2) as int))")).otherwise(F.substring("word", F.lit(1), first))
    keyed = rows.select(F.xxhash64("size", "mixed", "end", part).alias("key"), "word", "n", "size", "mixed", "end")
    # How many share a half is counted below the shuffle; most halves are one block.
    crowded = keyed.groupBy(F.col("key").alias("_key")).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > share)
    # At most one key for each ``share`` rows: small enough to broadcast.
    crowded = crowded.select("_key", F.ceil(F.col("rows") / share).cast("int").alias("parts"))
    found = keyed.join(F.broadcast(settle(crowded, "spelling-crowded")), F.col("key") == F.col("_key"), "left").drop("_key")
    mine = F.pmod(F.xxhash64("word"), F.coalesce("parts", F.lit(1))).cast("int")
    # A word of a crowded half is listed in its own part and asks in every one.
    asked = F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)
    spread = found.withColumn("mine", mine).withColumn("part", F.explode(asked))
    listed = (F.col("part") == F.col("mine")).alias("listed")
    return spread.select(F.xxhash64("key", "part").alias("key"), listed, "word", "n", "size", "mixed", "end")


class Index:
    """Bits of the listed words by place and letter.  Places count from 0; ends are a letter of their own."""

    def __init__(self, words: np.ndarray, groups: np.ndarray) -> None:
        """``words``: code points, one row for each word, zero beyond its end.  ``groups``: the key of each."""
        self.n, self.width = len(words), words.shape[1]
        self.letters = np.unique(np.append(words.ravel(), 0))
        ranks = np.searchsorted(self.letters, words)
        self.bits = np.zeros((self.width + 3, len(self.letters), -(-self.n // 64)), np.uint64)
        at = np.arange(self.n)
        bit = np.uint64(1) << (at % 64).astype(np.uint64)
        # Place 0 is before the first letter: nothing is there.  Beyond the width every word has ended.
        for p in range(self.width + 2):
            of = ranks[:, p] if p < self.width else np.zeros(self.n, np.int64)
            np.bitwise_or.at(self.bits[p + 1], (of, at // 64), bit)
        self.keys, place = np.unique(groups, return_inverse=True)
        self.members = np.zeros((len(self.keys), self.bits.shape[2]), np.uint64)
        np.bitwise_or.at(self.members, (place, at // 64), bit)

    def near(self, words: np.ndarray, groups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(asking word, listed word) of the same group that differ by exactly one letter."""
        n_letters = len(self.letters)
        rank = np.searchsorted(self.letters, words)
        known = self.letters[np.minimum(rank, n_letters - 1)] == words
        # A letter that no listed word has: an empty set, put behind the others.
        rank = np.where(known, rank, n_letters)
        bits = np.concatenate([self.bits, np.zeros_like(self.bits[:, :1])], axis=1)
        group = np.minimum(np.searchsorted(self.keys, groups), len(self.keys) - 1)
        same = np.where((self.keys[group] == groups)[:, None], self.members[group], np.uint64(0))
        none = np.zeros_like(same)
        replaced, dropped, added = none.copy(), none.copy(), none.copy()
        size = (words != 0).sum(axis=1)
        found = none.copy()
        for p in range(words.shape[1] + 1):
            letter = rank[:, p] if p < words.shape[1] else np.full(len(words), np.searchsorted(self.letters, 0))
            # At the asking word's end the listed word must end as well, one place earlier, or one later.
            here, earlier, later = bits[p + 1][letter], bits[p][letter], bits[p + 2][letter]
            over = (size == p)[:, None]
            if over.any():
                found |= np.where(over, (replaced & here) | (dropped & earlier) | ((added | same & ~here) & later), np.uint64(0))
            # Letters of the asking word against those of the listed ones at the same place, one earlier, one later.
            replaced, dropped, added, same = (
                (replaced & here) | (same & ~here),
                (dropped & earlier) | same,
                (added | same) & later,
                same & here,
            )
        asking, word = np.nonzero(found)
        if not len(asking):
            return asking, word
        spots = (found[asking, word][:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)
        which, bit = np.nonzero(spots)
        return asking[which], word[which] * 64 + bit


def _points(words: list[str], width: int) -> np.ndarray:
    out = np.zeros((len(words), width), np.uint32)
    for i, w in enumerate(words):
        out[i, : len(w)] = np.frombuffer(w.encode("utf-32-le"), "<u4")
    return out


#: (key, listed, word, n, size, mixed, end)
Row = tuple[int, bool, str, int, int, bool, bool]


class _Block:
    """Listed words of some keys, and their index."""

    def __init__(self, rows: list[Row], width: int) -> None:
        self.rows = rows
        self.points = _points([r[2] for r in rows], width)
        self.keys = np.array([r[0] for r in rows], np.int64)
        self.index = Index(self.points, self.keys)
        order = sorted(range(len(rows)), key=lambda i: rows[i][2])
        self.order = np.empty(len(rows), np.int64)
        self.order[order] = np.arange(len(rows))
        self.n = np.array([r[3] for r in rows], np.int64)

    def answer(self, asks: list[Row]) -> Iterator[tuple]:
        """(word, near words here, best of them, its count) of the asking words that have one."""
        points = _points([r[2] for r in asks], self.points.shape[1])
        i, j = self.index.near(points, np.array([r[0] for r in asks], np.int64))
        if not len(i):
            return
        a, b = points[i], self.points[j]
        size, mixed, end = (np.array([r[k] for r in asks])[i] for k in (4, 5, 6))
        place = np.arange(points.shape[1])
        # A pair that shares both halves counts by its first one; pairs of equal length count where only such meet.
        both = ((a == b) | (place >= (size // 2)[:, None])).all(axis=1)
        longer = (a != 0).sum(axis=1) != (b != 0).sum(axis=1)
        keep = ~(end & both) & (mixed == longer)
        i, j = i[keep], j[keep]
        order = np.lexsort((self.order[j], -self.n[j], i))
        i, j = i[order], j[order]
        first = np.flatnonzero(np.concatenate([[len(i) > 0], i[1:] != i[:-1]])) if len(i) else np.zeros(0, int)
        for k, count in zip(first.tolist(), np.diff(np.append(first, len(i))).tolist()):
            yield asks[i[k]][2], count, self.rows[j[k]][2], self.rows[j[k]][3]


def _blocks(rows: list[Row], width: int, block: int) -> Iterator[_Block]:
    """Blocks of at most so many words, fewer where words are very long."""
    step = max(1, min(block, (1 << 16) // width))
    for k in range(0, len(rows), step):
        yield _Block(rows[k : k + step], width)


def _chunks(rows: Iterator[Row], size: int) -> Iterator[list[Row]]:
    while part := list(islice(rows, size)):
        yield part


def _met(rows: Iterator[Row], block: int) -> Iterator[tuple]:
    """Answers to all rows, which come sorted by key, listed ones first."""
    pack: list[Row] = []

    def packed() -> Iterator[tuple]:
        width = max((len(r[2]) for r in pack), default=1)
        for b in _blocks(pack, width, block):
            for asks in _chunks(iter(pack), block):
                yield from b.answer(asks)
        pack.clear()

    for _, group in groupby(rows, key=lambda r: r[0]):
        head = list(islice(group, block))
        if len(head) < block:
            # Keys are packed whole, so that many small ones share a block.
            if len(pack) + len(head) > block:
                yield from packed()
            pack.extend(head)
            continue
        size = max(r[4] for r in head) + 1
        listed, first, rest = [], [], chain(head, group)
        for row in rest:
            if not row[1]:
                first = [row]
                break
            listed.append(row)
        blocks = list(_blocks(listed, size, block))
        for asks in _chunks(chain(listed, first, rest), block):
            for b in blocks:
                yield from b.answer(asks)
    yield from packed()


_ANSWER = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("form", pa.string()), ("form_n", pa.int64())])


def neighbours(words: DataFrame, share: int = SHARE, block: int = BLOCK) -> DataFrame:
    """(word, n_near, best, best_n) of the words of (word, n) that have another one letter apart: how many, and the most frequent of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
        for part in _chunks(_met(rows, block), 1 << 14):
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*part), _ANSWER)], schema=_ANSWER)

    dealt = _dealt(words, share).repartition("key").sortWithinPartitions("key", F.desc("listed"))
    answers = dealt.mapInArrow(run, "word string, n_near long, form string, form_n long")
    best = F.min(F.struct((-F.col("form_n")).alias("less"), "form")).alias("best")
    found = answers.groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
    return found.select("word", "n_near", F.col("best.form").alias("best"), (-F.col("best.less")).alias("best_n"))


def follow(forms: DataFrame) -> DataFrame:
    """(word, root) from the settled (word, form): where the chain of forms ends.  Each round doubles the steps taken, so a few suffice."""
    steps = forms
    while True:
        further = steps.select(F.col("word").alias("_at"), F.col("form").alias("_to"))
        moved = steps.join(further, F.col("form") == F.col("_at"), "left")
        moved = settle(moved.select("word", F.coalesce("_to", "form").alias("form"), F.col("_to").isNotNull().alias("moved")), "spelling-roots")
        if moved.filter("moved").isEmpty():
            return moved.select("word", F.col("form").alias("root"))
        steps = moved.select("word", "form")


def variants(words: DataFrame, ratio: int = 5, share: int = SHARE, block: int = BLOCK) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word of the settled vocabulary (word, n), whose words are distinct.

    A word's form is its most frequent near word, if that is at least ``ratio`` times as frequent; ``root`` is where forms lead.
    """
    known = words.join(neighbours(words, share, block), "word", "left")
    has = F.col("best_n") >= ratio * F.col("n")
    found = known.select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(has, F.col("best")).alias("form"), F.when(has, F.col("best_n")).alias("form_n")
    )
    found = settle(found, "spelling-forms")
    roots = follow(found.filter("form is not null").select("word", "form"))
    return found.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
