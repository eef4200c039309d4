"""Similarity join of texts by the Jaccard index of their shingles, with an R-tree over counts of hashed groups.

A text is the set of its distinct shingles.  Hashing them into groups makes it a point: how many shingles each group holds.  Two
sets share at most the sum, over the groups, of the smaller count, so a box of points can be left out of a search when the sum of the
smaller of the searched point's count and the box's upper bound is too low.  Pairs that pass are verified on their sets.

Boxes of a tree over *all* points would not part them: at a similarity of 0.9 and 300 shingles in 16 groups, texts that have nothing in
common are 2.5 times as far apart as texts that may be alike, so a tree of a million points would have to look into more than half of
its leaves.  So points are dealt first: the space of hashes is cut into more parts than shingles may differ between two texts alike;
each part beyond that is one more in which they agree exactly.  Texts that agree in one part are a cell, and the tree is
built over the points of a cell, where common phrases, short texts and families of near copies crowd.

Parts of few shingles tell little: long texts that have but a phrase in common agree in some.  A text is not dealt by its smallest parts, as
many as there are spare ones.  Parts are ordered by what they hold, so of two texts one leaves out all agreeing parts that the other does; since
they agree in one part more than are spare, they still meet.  Keys of cells are packed; those that two texts have are found on short
parts of the keys, and only these are dealt as rows.

Texts of a cell are not paired all with all: each is first compared with one of the cell, which joins families of near copies at a cost
in proportion to their size; only cells with texts not joined so are searched, and only for pairs not joined yet.  A cell of many
texts is cut into blocks, and each pair of blocks is searched wherever it is dealt.  No link between different sets is lost.

Null, empty and blank texts have no shingle and are linked with nothing.  Equal sets are one node.  Rows without an id get the smallest
id of their group, null if there is none; repeated rows each get a row.  Texts of any length are read whole.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.llm.components import components
from panelspark.llm.shingles import shingle_sets
from panelspark.llm.store import drop, settle
from panelspark.llm.words import buffer_of, mix, slices

U = np.uint64
#: Sizes of sets are banded: each band reaches a quarter further than the one before.
BAND = 1.25
#: Parts beyond what differs, in hundredths of these (one at least): so many of the smallest parts of a text make no cell.
SPARE = 60
#: Bytes of a packed key: texts that meet by chance are found unlike.
KEY_BYTES = 6
#: Keys packed at a time, and keys of a bucket in which repeated ones are looked for.
PACKED, BUCKET_KEYS = 1 << 19, 1 << 18
#: Points of a leaf, and bytes of counts of one block of a cell.
LEAF, BLOCK_BYTES = 32, 8 << 20
#: Groups of a point: a row of a cell has a bound that does not depend on the length of its text.
GROUPS = 128
#: Cells that a node names when its pairs are looked for.
LISTED = 16
#: Bits of the filter for each wanted set, and at most.
WANTED_BITS, MOST_BITS = 16, 1 << 31


def most_different(total: np.ndarray | int, percent: int) -> np.ndarray | int:
    """Shingles that are in only one of two sets with ``total`` elements together, at most, if they are linked."""
    return total * (100 - percent) // (100 + percent)


class Bands:
    """Last sizes of the bands, as many as were asked for."""

    def __init__(self) -> None:
        self.last = np.array([1], np.int64)

    def of(self, sizes: np.ndarray) -> np.ndarray:
        """The band of each size."""
        while len(sizes) and self.last[-1] < sizes.max():
            self.last = np.append(self.last, max(self.last[-1] + 1, int(self.last[-1] * BAND)))
        return np.searchsorted(self.last, sizes)


_BANDS = Bands()


def cell_keys(hashes: np.ndarray, bounds: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the cells of each text, and their bounds; ``hashes`` are sorted within a text.

    A pair is found in the band of its larger set, so a text is dealt in its own band and in those of larger sets that it may be linked with.
    """
    n = np.diff(bounds)
    texts = np.arange(len(n))
    first, final = _BANDS.of(n), _BANDS.of(n * 100 // percent)
    sums = np.zeros(len(hashes) + 1, U)
    with np.errstate(over="ignore"):
        np.cumsum(mix(hashes ^ U(0x5851F42D4C957F2D)), dtype=U, out=sums[1:])
    keys, owners = [np.zeros(0, U)], [np.zeros(0, np.int64)]
    for step in range(int((final - first).max()) + 1 if len(n) else 0):
        band = first + step
        differ = most_different(2 * _BANDS.last[np.minimum(band, len(_BANDS.last) - 1)], percent)
        # Where nothing may differ only equal sets are linked, and these are one node.
        some = texts[(band <= final) & (n > 0) & (differ > 0)]
        if not len(some):
            continue
        spare = np.maximum(1, differ[some] * SPARE // 100)
        parts = differ[some] + 1 + spare
        start = np.cumsum(parts) - parts
        of = np.repeat(some, n[some])
        at = np.repeat(bounds[:-1][some] - (np.cumsum(n[some]) - n[some]), n[some]) + np.arange(len(of))
        part = ((hashes[at] >> U(32)) * np.repeat(parts, n[some]).astype(U)) >> U(32)
        slot = np.repeat(start, n[some]) + part.astype(np.int64)
        total = int(parts.sum())
        low = np.searchsorted(slot, np.arange(total))
        high = np.append(low[1:], len(slot))
        empty = low == high
        ends = np.append(at, len(hashes))
        with np.errstate(over="ignore"):
            value = np.where(empty, U(0), sums[ends[np.maximum(high, 1) - 1] + 1] - sums[ends[low]])
            place = np.arange(total) - np.repeat(start, parts)
            key = mix(value ^ mix((np.repeat(band[some], parts) << 32).astype(U) + place.astype(U)))
        # By size, then by what they hold: the order is the same in every text.
        order = np.lexsort((key, high - low, np.repeat(some, parts)))
        kept = np.zeros(total, bool)
        kept[order[place >= np.repeat(spare, parts)]] = True
        keys.append(key[kept])
        owners.append(np.repeat(some, parts)[kept])
    keys, owners = np.concatenate(keys), np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    return keys[order], np.concatenate([[0], np.cumsum(np.bincount(owners, minlength=len(n)))]).astype(np.int64)


#: What a byte of a point stands for: counts as they are up to 191, then steps of 29 % up to more than a set can hold, rounded up.
_COUNTS = np.concatenate([np.arange(192), np.ceil(192 * 1.29 ** np.arange(64))]).astype(np.int64)


def _coded(counts: np.ndarray) -> np.ndarray:
    """Counts as bytes; none stands for less than its count, so no bound on what two sets share is too low."""
    return np.searchsorted(_COUNTS, counts).astype(np.uint8)


def _counted(points: np.ndarray) -> np.ndarray:
    """The counts that the bytes of points stand for; points of small counts are these themselves."""
    return points if points.max(initial=0) < 192 else _COUNTS[points]


def counts_of(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The points: for each text the counts of its groups, a byte each (:func:`_coded`)."""
    n = np.diff(bounds)
    slot = np.repeat(np.arange(len(n)) * GROUPS, n) + (mix(hashes) & U(GROUPS - 1)).astype(np.int64)
    return _coded(np.bincount(slot, minlength=len(n) * GROUPS).reshape(len(n), GROUPS))


def _digests(hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits that stand for a set."""
    some = np.diff(bounds) > 0
    out = []
    for seed in (0x2545F4914F6CDD1D, 0x9FB21C651E98DF25):
        digest = np.zeros(len(some), U)
        if some.any():
            digest[some] = np.add.reduceat(mix(hashes ^ U(seed)), bounds[:-1][some])
        out.append(digest.view(np.int64))
    return out[0], out[1]


def _lists(values: np.ndarray, bounds: np.ndarray, kept: np.ndarray) -> pa.Array:
    """One list of longs for each kept text, null for the others."""
    size = np.where(kept, np.diff(bounds), 0)
    picked = values[np.repeat(kept, np.diff(bounds))].view(np.int64)
    at = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
    return pa.LargeListArray.from_arrays(pa.array(at), pa.array(picked), mask=pa.array(~kept))


def _pack(keys: np.ndarray) -> bytes:
    """The highest :data:`KEY_BYTES` bytes of each key."""
    return np.ascontiguousarray((keys >> U(64 - 8 * KEY_BYTES)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :KEY_BYTES]).tobytes()


def _unpacked(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Packed keys of some texts as longs, and how many each has; a null has none."""
    size = np.array([0 if x is None else x // KEY_BYTES for x in pc.binary_length(lists).to_pylist()], np.int64)
    whole = b"".join(x.as_buffer() for x in lists if x.is_valid)
    out = np.zeros((len(whole) // KEY_BYTES, 8), np.uint8)
    out[:, :KEY_BYTES] = np.frombuffer(whole, np.uint8).reshape(-1, KEY_BYTES)
    return out.view("<i8").ravel(), size


def described(docs: DataFrame, id_col: str, text_col: str, shingle: int, percent: int, extra: Callable[[np.ndarray, np.ndarray], np.ndarray] | None) -> DataFrame:
    """(id, n, d0, d1, keys, point, extra) for every row; keys and point are null where a row nearby has the same set.

    ``extra`` makes a long for each text of a slice, from its bytes and offsets.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, d, o in slices(*buffer_of(batch.column(1))):
                hashes, bounds, _ = shingle_sets(d, o, shingle)
                d0, d1 = _digests(hashes, bounds)
                n = np.diff(bounds)
                kept = np.zeros(len(n), bool)
                kept[np.unique(d0, return_index=True)[1]] = True
                keys, key_bounds = cell_keys(hashes, bounds, percent)
                points = [p.tobytes() if k else None for p, k in zip(counts_of(hashes, bounds), kept.tolist())]
                packed, at = _pack(keys), (key_bounds * KEY_BYTES).tolist()
                lists = [packed[x:y] if k else None for x, y, k in zip(at[:-1], at[1:], kept.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, end - first), pa.array(n), pa.array(d0), pa.array(d1), pa.array(lists, pa.binary()), pa.array(points, pa.binary()),
                     pa.array(extra(d, o)) if extra else pa.nulls(len(n), pa.int64())],
                    names=["id", "n", "d0", "d1", "keys", "point", "extra"],
                )

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, n long, d0 long, d1 long, keys binary, point binary, extra long")


def some_of(rows: DataFrame, column: str) -> Broadcast:
    """Bits of a filter over the longs in a column of the settled ``rows``: 16 for each, and 256 MB at most; what passes by chance is joined away."""
    bits = 1 << 10
    n = rows.count()
    while bits < min(MOST_BITS, n * WANTED_BITS):
        bits *= 2
    slot = F.col(column).bitwiseAND(bits - 1)
    words = rows.select(F.shiftright(slot, 6).alias("word"), F.expr(f"shiftleft(1L, cast({column} & 63 as int))").alias("bit"))
    found = words.groupBy("word").agg(F.bit_or("bit").alias("bit")).toArrow()
    table = np.zeros(bits // 64, np.int64)
    table[found.column(0).to_numpy()] = found.column(1).to_numpy()
    return rows.sparkSession.sparkContext.broadcast(table.view(U))


def passes(table: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Which values the filter lets pass: all that were put into it, and one other in 16."""
    slot = values.view(U) & U(64 * len(table) - 1)
    return (table[(slot >> U(6)).astype(np.int64)] >> (slot & U(63)) & U(1)).astype(bool)


def sets_of(docs: DataFrame, nodes: DataFrame, text_col: str, shingle: int) -> DataFrame:
    """(node, shingles) of the settled ``nodes`` (node, d0, d1), from the texts; a text that occurs often is sent once by each task at most."""
    wanted = some_of(nodes, "d0")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = wanted.value
        seen = np.zeros(0, np.int64)
        for batch in batches:
            for _, _, d, o in slices(*buffer_of(batch.column(0))):
                hashes, bounds, _ = shingle_sets(d, o, shingle)
                d0, d1 = _digests(hashes, bounds)
                kept = passes(table, d0) & (np.diff(bounds) > 0)
                once = np.zeros(len(d0), bool)
                once[np.unique(d0, return_index=True)[1]] = True
                kept &= once & ~np.isin(d0, seen)
                # The last thousands of sets are remembered, which stops runs of copies.
                seen = np.concatenate([seen, d0[kept]])[-(1 << 14) :]
                if kept.any():
                    lists = _lists(hashes, bounds, kept).cast(pa.list_(pa.int64())).filter(pa.array(kept))
                    yield pa.RecordBatch.from_arrays([pa.array(d0[kept]), pa.array(d1[kept]), lists], names=["d0", "d1", "shingles"])

    sets = docs.select(text_col).mapInArrow(run, "d0 long, d1 long, shingles array<long>")
    named = sets.join(nodes.select("node", F.col("d0").alias("_d0"), F.col("d1").alias("_d1")), (F.col("d0") == F.col("_d0")) & (F.col("d1") == F.col("_d1")))
    # By the digests, as in the join, so that the sets are not shuffled once more; a node has its own digests.
    return settle(named.groupBy("d0", "d1").agg(F.first("node").alias("node"), F.first("shingles").alias("shingles")).select("node", "shingles"), "jaccard-sets")


def fitting(pairs: DataFrame, points: DataFrame, percent: int) -> DataFrame:
    """Those of ``pairs`` (a, b) that may be linked by their points; ``points``: (node, n, point), a point having a power of two of groups."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_a, n_b, of_a, of_b = (batch.column(k) for k in range(2, 6))
            need = -(-percent * (n_a.to_numpy() + n_b.to_numpy()) // (100 + percent))
            shared = np.zeros(len(need), np.int64)
            for k in range(len(need)):
                x, y = (_counted(np.frombuffer(c[k].as_buffer(), np.uint8)) for c in (of_a, of_b))
                if len(x) != len(y):
                    groups = min(len(x), len(y))
                    x, y = (p.reshape(-1, groups).sum(axis=0, dtype=np.int64) for p in (x, y))
                shared[k] = np.minimum(x, y).sum(dtype=np.int64)
            kept = pa.array(shared >= need)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(kept), batch.column(1).filter(kept)], names=["a", "b"])

    # b first: many different ones, which are dealt evenly; a may be one text that thousands are compared with.
    half = pairs.join(points.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("point").alias("of_b")), "b")
    both = half.join(points.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("point").alias("of_a")), "a")
    return both.select("a", "b", "n_a", "n_b", "of_a", "of_b").mapInArrow(run, "a long, b long")


def fine_points(sets: DataFrame) -> DataFrame:
    """(node, n, point) of the settled ``sets`` (node, shingles), with at least a group for each shingle: much tighter, and long for long texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, points = [], []
            for k in range(batch.num_rows):
                h = batch.column(1)[k].values.to_numpy().view(U)
                groups = max(GROUPS, 1 << (len(h) - 1).bit_length())
                counts = np.bincount((mix(h) & U(groups - 1)).astype(np.int64), minlength=groups)
                points.append(_coded(counts).tobytes())
                sizes.append(len(h))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(points, pa.binary())], names=["node", "n", "point"])

    return sets.mapInArrow(run, "node long, n long, point binary")


def verified(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, text_col: str, shingle: int, percent: int, bounded: bool = False) -> DataFrame:
    """Those of the settled, distinct ``pairs`` (a, b) that are linked: bounded by short points (unless they are ``bounded``), then by long ones, then compared."""
    n = pairs.count()
    pairs = pairs if bounded else settle(fitting(pairs, nodes.select("node", "n", "point"), percent), "jaccard-fitting", rows=n)
    ends = settle(pairs.select(F.explode(F.array("a", "b")).alias("_node")).distinct(), "jaccard-ends", rows=2 * n)
    sets = sets_of(docs, settle(nodes.join(ends, F.col("node") == F.col("_node")).select("node", "d0", "d1"), "jaccard-wanted"), text_col, shingle)
    pairs = settle(fitting(pairs, settle(fine_points(sets), "jaccard-fine"), percent), "jaccard-close", rows=n)
    half = pairs.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("of_b")), "b")
    both = half.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("of_a")), "a")
    shared = F.size(F.array_intersect("of_a", "of_b"))
    union = F.size("of_a") + F.size("of_b") - shared
    links = settle(both.filter(100 * shared >= percent * union).select("a", "b"), "jaccard-links", rows=n)
    drop(sets)
    return links


class Tree:
    """Boxes over points: each node knows the highest count of every group, the smallest and largest set and the one label, if there is one."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray, labels: np.ndarray, percent: int) -> None:
        self.points, self.sizes, self.labels, self.percent = points, sizes, labels, percent

    def _need(self, q: np.ndarray, least: np.ndarray | int) -> np.ndarray:
        """Shingles that a set must share at least with one of ``least`` elements or more."""
        return -(-self.percent * (self.sizes[q] + least) // (100 + self.percent))

    def pairs(self, side: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of points of different labels that may be linked, by descending with all points at once.

        With ``side`` (two values) only pairs of different sides: the points of one are searched in the boxes of the other.
        """
        if side is None:
            yield from self._visit(np.arange(len(self.sizes)), np.arange(len(self.sizes)), True)
        elif (side != side[0]).any():
            yield from self._visit(np.flatnonzero(side == side[0]), np.flatnonzero(side != side[0]), False)

    def _fits(self, asks: np.ndarray, others: np.ndarray) -> np.ndarray:
        """Which pairs of points share enough by their counts."""
        out = np.zeros(len(asks), bool)
        step = max(1, (1 << 21) // self.points.shape[1])
        for k in range(0, len(asks), step):
            a, b = asks[k : k + step], others[k : k + step]
            shared = np.minimum(self.points[a], self.points[b]).sum(axis=1, dtype=np.int64)
            out[k : k + step] = shared >= self._need(a, self.sizes[b])
        return out

    def _visit(self, inside: np.ndarray, asks: np.ndarray, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """``inside``: points of this node; ``asks``: points that may be linked with one of them; ``same``: both are of one set."""
        sizes, labels = self.sizes[inside], self.labels[inside]
        fits = (100 * self.sizes[asks] >= self.percent * sizes.min()) & (self.percent * self.sizes[asks] <= 100 * sizes.max())
        if (labels == labels[0]).all():
            fits &= self.labels[asks] != labels[0]
        asks = asks[fits]
        if not len(asks):
            return
        high = self.points[inside].max(axis=0)
        step = max(1, (1 << 21) // len(high))
        bound = [np.minimum(self.points[asks[k : k + step]], high).sum(axis=1, dtype=np.int64) for k in range(0, len(asks), step)]
        asks = asks[np.concatenate(bound) >= self._need(asks, sizes.min())]
        if not len(asks):
            return
        if len(inside) <= LEAF:
            a, b = np.repeat(asks, len(inside)), np.tile(inside, len(asks))
            some = self.labels[a] != self.labels[b]
            some &= (a < b) | (not same)
            a, b = a[some], b[some]
            if len(a):
                fits = self._fits(a, b)
                yield a[fits], b[fits]
            return
        # Cut at the median of the group whose counts differ most, or of the sizes.
        spread = self.points[inside].astype(np.float32).var(axis=0)
        by = self.points[inside, int(spread.argmax())] if spread.max() > 0 else sizes
        order = inside[np.lexsort((sizes, by))]
        middle = len(order) // 2
        yield from self._visit(order[:middle], asks, same)
        yield from self._visit(order[middle:], asks, same)


def searched(rows: DataFrame, percent: int, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(a, b): pairs of nodes of the settled ``rows`` (key, node, n, label, point) that share a key, not a label, and may be linked.

    A pair that shares several cells is returned by the first of them, as far as the lists of a node's first :data:`LISTED` cells tell.
    """
    sizes = rows.groupBy(F.col("key").alias("_key")).agg(F.ceil(F.sum(F.length("point")) / block_bytes).cast("int").alias("parts"))
    # Few cells are cut; what is not found here has one part.  One row for each block's bytes of points at most.
    sizes = settle(sizes.filter("parts > 1"), "jaccard-crowded")
    sized = rows.join(sizes, F.col("key") == F.col("_key"), "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    mine = F.pmod(F.xxhash64("node"), "parts").cast("int")
    spread = sized.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    cell = F.xxhash64("key", F.least("mine", "other"), F.greatest("mine", "other"))
    lists = rows.groupBy(F.col("node").alias("_node")).agg(F.slice(F.array_sort(F.collect_set("key")), 1, LISTED).alias("listed"))
    spread = spread.join(lists, F.col("node") == F.col("_node"))
    side = F.when(F.col("mine") != F.col("other"), F.col("mine"))
    dealt = spread.select(cell.alias("cell"), "key", "node", "n", "label", "point", "listed", side.alias("side"))

    def met(cells: list[tuple]) -> Iterator[pa.RecordBatch]:
        key = cells[0][1]
        node, n, label = (np.array([r[k] for r in cells], np.int64) for k in (2, 3, 4))
        tree = Tree(_counted(np.stack([np.frombuffer(r[5], np.uint8) for r in cells])), n, label, percent)
        listed: dict[int, frozenset] = {}

        def first(a: int, b: int) -> bool:
            for k in (a, b):
                if k not in listed:
                    listed[k] = frozenset(cells[k][6])
            return min(listed[a] & listed[b], default=key) == key

        for i, j in tree.pairs(None if cells[0][7] is None else np.array([r[7] for r in cells])):
            here = np.fromiter(map(first, i.tolist(), j.tolist()), bool, len(i))
            i, j = i[here], j[here]
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(node[i], node[j])), pa.array(np.maximum(node[i], node[j]))], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wait: list[tuple] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if wait and wait[0][0] != row[0]:
                    yield from met(wait)
                    wait = []
                wait.append(row)
        if wait:
            yield from met(wait)

    return dealt.repartition("cell").sortWithinPartitions("cell").mapInArrow(run, "a long, b long")


def _slots(keys: np.ndarray, bits: int) -> np.ndarray:
    """What is compared of keys: the bits of the bucket above 32 others, or as many as are left."""
    return keys >> max(8 * KEY_BYTES - 32 - bits, 0)


def _repeated(nodes: DataFrame, bits: int) -> DataFrame:
    """(slot): those that occur more than once among the keys of all nodes.

    Keys go to ``2 ** bits`` buckets as packs of 4 bytes a key, not as a row each; most never leave the task that reads their bucket.
    """
    low = min(32, 8 * KEY_BYTES - bits)

    def packs(keys: list[np.ndarray]) -> pa.RecordBatch:
        slots = np.sort(_slots(np.concatenate(keys), bits))
        bucket = slots >> low
        starts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(slots) else np.zeros(0, np.int64)
        at = (np.append(starts, len(slots)) * 4).astype(np.int32)
        rest = (slots & ((1 << low) - 1)).astype("<u4").tobytes()
        data = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(at), pa.py_buffer(rest)])
        return pa.RecordBatch.from_arrays([pa.array(bucket[starts].astype(np.int32)), data], names=["bucket", "rest"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wait, n = [], 0
        for batch in batches:
            keys, _ = _unpacked(batch.column(0))
            wait.append(keys)
            n += len(keys)
            if n >= PACKED:
                yield packs(wait)
                wait, n = [], 0
        if n:
            yield packs(wait)

    def twice(bucket: int, parts: list[np.ndarray]) -> pa.RecordBatch:
        rest = np.sort(np.concatenate(parts))
        rest = np.unique(rest[1:][rest[1:] == rest[:-1]]).astype(np.int64)
        return pa.RecordBatch.from_arrays([pa.array((bucket << low) + rest)], names=["slot"])

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, wait = None, []
        for batch in batches:
            for bucket, rest in zip(batch.column(0).to_pylist(), batch.column(1)):
                if wait and bucket != last:
                    yield twice(last, wait)
                    wait = []
                last = bucket
                wait.append(np.frombuffer(rest.as_buffer(), "<u4"))
        if wait:
            yield twice(last, wait)

    dealt = nodes.select("keys").mapInArrow(run, "bucket int, rest binary").repartition("bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(found, "slot long")


def _members(nodes: DataFrame, bucket_keys: int = BUCKET_KEYS) -> DataFrame:
    """(key, hub, node) of cells with several nodes; hub is the smallest of them."""
    n = (nodes.agg(F.sum(F.length("keys"))).first()[0] or 0) // KEY_BYTES
    bits = min(max(12, (n // bucket_keys).bit_length()), 24)
    wanted = some_of(settle(_repeated(nodes, bits), "jaccard-repeated"), "slot")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, size = _unpacked(batch.column(1))
            kept = passes(wanted.value, _slots(keys, bits))
            owner = np.repeat(batch.column(0).to_numpy(), size)
            yield pa.RecordBatch.from_arrays([pa.array(owner[kept]), pa.array(keys[kept])], names=["node", "key"])

    # Most cells have one node: their keys never become rows.
    found = settle(nodes.select("node", "keys").mapInArrow(run, "node long, key long"), "jaccard-keyed")
    cells = found.groupBy(F.col("key").alias("_key")).agg(F.min("node").alias("hub"), F.max("node").alias("last")).filter("hub < last")
    return settle(found.join(cells, F.col("key") == F.col("_key")).select("key", "hub", "node"), "jaccard-members")


def linked(
    docs: DataFrame, nodes: DataFrame, text_col: str, shingle: int, percent: int, block_bytes: int = BLOCK_BYTES, known: DataFrame | None = None
) -> DataFrame:
    """(node, root) of the settled ``nodes`` (node, n, d0, d1, keys, point) that are linked with others: root is the smallest one reached.

    ``known``: links (a, b) that were found before; what they join is not compared again.
    """
    members = _members(nodes)

    def roots_of(links: DataFrame, label: str) -> DataFrame:
        return settle(components(links, links.count()).select(F.col("node").alias("_node"), "root"), label)

    stars = members.filter("hub <> node").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
    if known is not None:
        roots = roots_of(known, "jaccard-known")
        ends = [roots.select(F.col("_node").alias(f"_{e}"), F.col("root").alias(f"root_{e}")) for e in "ab"]
        joined = stars.join(ends[0], F.col("a") == F.col("_a"), "left").join(ends[1], F.col("b") == F.col("_b"), "left")
        stars = joined.filter(F.coalesce("root_a", "a") != F.coalesce("root_b", "b")).select("a", "b")
    links = verified(settle(stars, "jaccard-stars", rows=members.count()), nodes, docs, text_col, shingle, percent)
    links = links if known is None else links.unionByName(known)
    labels = roots_of(links, "jaccard-roots")
    labelled = members.join(labels, F.col("node") == F.col("_node"), "left").select("key", "node", F.coalesce("root", "node").alias("label"))
    labelled = settle(labelled, "jaccard-labelled")
    apart = labelled.groupBy(F.col("key").alias("_key")).agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low < high")
    # The key is dealt anew as an expression, so that a crowded cell can be split.
    apart = labelled.join(apart.select(F.expr("_key ^ 0").alias("_key")), F.col("key") == F.col("_key"), "left_semi")
    points = nodes.select(F.col("node").alias("_node"), "n", "point")
    apart = settle(apart.join(points, F.col("node") == F.col("_node")).select("key", "node", "n", "label", "point"), "jaccard-open")
    pairs = settle(searched(apart, percent, block_bytes).distinct(), "jaccard-pairs")
    more = verified(pairs, nodes, docs, text_col, shingle, percent, bounded=True)
    links = links.unionByName(more)
    return components(links, links.count())


def sets_and_nodes(
    docs: DataFrame, id_col: str, text_col: str, shingle: int, percent: int, extra: Callable[[np.ndarray, np.ndarray], np.ndarray] | None = None
) -> tuple[DataFrame, DataFrame]:
    """(id, n, d0, d1) of every row, and (node, n, d0, d1, least, keys, point, extra) of every set of at least one shingle; both settled."""
    found = settle(described(docs, id_col, text_col, shingle, percent, extra), "jaccard-rows")
    same = found.filter("n > 0").groupBy("d0", "d1", "n")
    kept = [F.first(c, True).alias(c) for c in ("keys", "point", "extra")]
    nodes = settle(same.agg(F.min("id").alias("least"), *kept).withColumn("node", F.monotonically_increasing_id()), "jaccard-nodes")
    rows = settle(found.select("id", "n", "d0", "d1"), "jaccard-ids")
    drop(found)
    return rows, nodes


def named_groups(rows: DataFrame, nodes: DataFrame, roots: DataFrame) -> DataFrame:
    """(id, n, component_id) for every row, from the roots of the nodes that are linked."""
    roots = settle(roots, "jaccard-groups")
    named = nodes.select(F.col("node").alias("_node"), "least").join(roots, F.col("_node") == F.col("node"))
    reached = named.groupBy(F.col("root").alias("_root")).agg(F.min("least").alias("reached"))
    grouped = named.join(reached, F.col("root") == F.col("_root")).select("node", "reached")
    ids = nodes.select("node", "least", "d0", "d1").join(grouped, "node", "left")
    ids = ids.select(F.col("d0").alias("_d0"), F.col("d1").alias("_d1"), F.coalesce("reached", "least").alias("component_id"))
    found = rows.join(ids, (F.col("d0") == F.col("_d0")) & (F.col("d1") == F.col("_d1")) & (F.col("n") > 0), "left")
    return found.select("id", "n", F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"))


def jaccard_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, percent: int = 90, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """One row per input row: id, n_shingles, component_id (the smallest id reachable over links).

    Texts are linked when ``100 * intersection >= percent * union`` of their sets of shingles (all words as one, where there are fewer).
    """
    rows, nodes = sets_and_nodes(docs, id_col, text_col, shingle, percent)
    found = named_groups(rows, nodes, linked(docs, nodes, text_col, shingle, percent, block_bytes))
    return found.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id")
