"""SimHash fingerprints and their groups, by deletion variants of a few long segments.

Fingerprints are cut into so few segments that one of them differs in at most one bit.  Every segment is indexed once for each
of its bits, that bit left out; fingerprints whose variants are equal meet and are verified on all bits.

:func:`drop_near_copies` decides by the texts' shingles, not by fingerprints: these only find most links at low cost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.llm import jaccard
from panelspark.llm.components import components
from panelspark.llm.shingles import SEED, shingles_of
from panelspark.llm.store import settle
from panelspark.llm.words import buffer_of, mix, slices
from panelspark.llm.xxh64 import xxh64

#: Spreads the bits of a byte over the byte lanes of a 64-bit word: lane k gets bit k.
_LANES = sum((((np.arange(256, dtype=np.uint64) >> np.uint64(k)) & np.uint64(1)) << np.uint64(8 * k)) for k in range(8))


def majority(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """For each text the bits that are set in over half of its hashes; zero where it has none."""
    n_texts, size = len(bounds) - 1, np.diff(bounds)
    out = np.zeros(n_texts, np.uint64)
    if not len(hashes):
        return out
    # Sums of up to 255 hashes fit into byte lanes; each text is cut into such blocks.
    blocks = -(-size // 255)
    first = np.repeat(bounds[:-1], blocks) + 255 * (np.arange(blocks.sum()) - np.repeat(np.cumsum(blocks) - blocks, blocks))
    starts = np.flatnonzero(blocks)
    at = (np.cumsum(blocks) - blocks)[starts]
    as_bytes = hashes.view(np.uint8).reshape(-1, 8)
    half = size[starts] / 2
    for byte in range(8):
        lanes = np.add.reduceat(_LANES[as_bytes[:, byte]], first)
        counts = np.add.reduceat(lanes.view(np.uint8).reshape(-1, 8).astype(np.int64), at, axis=0)
        for k in range(8):
            out[starts] |= (counts[:, k] > half).astype(np.uint64) << np.uint64(8 * byte + k)
    return out


def fingerprint_slice(data: np.ndarray, offsets: np.ndarray, shingle: int, width: int = 1) -> np.ndarray:
    """Fingerprints of a run of texts, ``width`` words of 64 bits each, from their shingles (all words, where a text has fewer).

    The first word is made of the shingles' XXH64 hashes, further ones of these hashes mixed anew.
    """
    words, start, end, bounds = shingles_of(data, offsets, shingle)
    hashes = xxh64(words.data, start, end, SEED)
    more = [mix(hashes ^ np.uint64(k)) for k in range(1, width)]
    return np.stack([majority(h, bounds) for h in (hashes, *more)], axis=1)


def _names(width: int) -> list[str]:
    return [f"fp{k}" for k in range(width)]


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, width: int = 1) -> DataFrame:
    """(id, fp0, …): a fingerprint of ``width`` signed longs for each row.  Null and empty texts have fingerprint zero."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [fingerprint_slice(d, o, shingle, width) for _, _, d, o in slices(*buffer_of(batch.column(1)))]
            fp = np.concatenate(parts).view(np.int64) if parts else np.zeros((0, width), np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(np.ascontiguousarray(fp[:, k])) for k in range(width))], names=["id", *_names(width)]
            )

    longs = "".join(f", {n} long" for n in _names(width))
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}{longs}")


#: A bucket is compared as it stands up to so many members; larger ones are cut finer (see :func:`links`).
BUCKET = 2048
#: Bits of a key that tell its mask; the others are a hash, and what meets by chance is found unlike.
MASK_BITS = 20


def cuts(fixed: int, segments: int, width: int = 1) -> list[int]:
    """Masks of the bits that a variant keeps: the free bits of ``fixed`` in segments, each with one bit left out.

    If all in all fewer than ``2 * segments`` bits differ, some segment differs in at most one; then the variant that leaves
    this bit out is the same for both fingerprints.
    """
    free = [i for i in range(64 * width) if not fixed >> i & 1]
    found = []
    for k in range(segments):
        segment = free[k * len(free) // segments : (k + 1) * len(free) // segments]
        whole = sum(1 << i for i in segment)
        found += [fixed | (whole ^ (1 << i)) for i in segment]
    return found or [fixed]


def _longs(x: int, width: int) -> list[int]:
    """A bit set as signed longs, lowest first."""
    parts = [x >> 64 * k & (1 << 64) - 1 for k in range(width)]
    return [p - (1 << 64) if p >> 63 else p for p in parts]


def _union(pairs: Iterator[tuple[int, int]]) -> list[tuple[int, int]]:
    """The pairs that join what earlier ones have not joined."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.get(x, x)) != x:
            parent[x] = parent.get(up, up)
            x = up
        return x

    kept = []
    for a, b in pairs:
        x, y = root(a), root(b)
        if x != y:
            parent[max(x, y)] = min(x, y)
            kept.append((a, b))
    return kept


def _compare(key: np.ndarray, fp: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows with equal (sorted) key whose fingerprints differ in at most ``radius`` bits."""
    left, right = [np.zeros(0, int)], [np.zeros(0, int)]
    i, lag = np.arange(len(key)), 1
    while True:
        i = i[i + lag < len(key)]
        i = i[key[i] == key[i + lag]]
        if not len(i):
            return np.concatenate(left), np.concatenate(right)
        near = i[sum(np.bitwise_count(f[i] ^ f[i + lag]) for f in fp) <= radius]
        left.append(near)
        right.append(near + lag)
        lag += 1


def _buckets(batches: Iterator[pa.RecordBatch], bucket: int) -> Iterator[tuple[list[np.ndarray], bool]]:
    """(columns, crowded) of rows that come sorted by their first column: whole buckets of 2 to ``bucket`` rows, and rows of larger ones."""
    # The last key of a batch may go on in the next one: its rows wait, or are passed on as too many once there are more
    # than a bucket holds.
    wait, large = None, None
    for batch in batches:
        now = [np.asarray(c) for c in batch.columns]
        if wait is not None:
            now = [np.concatenate(x) for x in zip(wait, now)]
        key = now[0]
        if not len(key):
            continue
        starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        size = np.diff(np.concatenate([starts, [len(key)]]))
        too_many = size > bucket
        if large is not None and key[0] == large:
            too_many[0] = True
        large = key[-1] if too_many[-1] else None
        many = np.repeat(too_many, size)
        if many.any():
            yield [x[many] for x in now], True
        tail = starts[-1] if large is None else len(key)
        done = ~many
        done[tail:] = False
        # One row alone in its bucket is like nothing; most rows are.
        done &= np.repeat(size > 1, size)
        if done.any():
            yield [x[done] for x in now], False
        wait = [x[tail:] for x in now]
    if wait is not None and len(wait[0]):
        yield wait, False


def _bucket_links(rows: DataFrame, radius: int, bucket: int, final: set[int]) -> DataFrame:
    """(a, b, mask) from (key, node, fp0, …): links inside each bucket, and the members of too large ones with their mask (b null).

    Buckets of a ``final`` mask, which no cut makes smaller, are compared at any size: fingerprints are distinct, so they have few members.
    """

    def out(a: np.ndarray, b: np.ndarray | None, mask: np.ndarray | None) -> pa.RecordBatch:
        none = pa.nulls(len(a), pa.int64())
        return pa.RecordBatch.from_arrays(
            [pa.array(a), none if b is None else pa.array(b), none if mask is None else pa.array(mask)], names=["a", "b", "mask"]
        )

    def linked(key: np.ndarray, node: np.ndarray, *fp: np.ndarray) -> pa.RecordBatch:
        i, j = _compare(key, [f.view(np.uint64) for f in fp], radius)
        pairs = np.array(_union(zip(node[i].tolist(), node[j].tolist())), np.int64).reshape(-1, 2)
        return out(pairs[:, 0], pairs[:, 1], None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for now, crowded in _buckets(batches, bucket):
            yield out(now[1], None, now[0] & ((1 << MASK_BITS) - 1)) if crowded else linked(*now)

    def run_final(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for now, _ in _buckets(batches, 1 << 40):
            yield linked(*now)

    if final:
        sorted_rows = rows.repartition("key").sortWithinPartitions("key")
        ends = F.col("key").bitwiseAND((1 << MASK_BITS) - 1).isin(sorted(final))
        done = sorted_rows.filter(ends).mapInArrow(run_final, "a long, b long, mask long")
        return done.unionByName(sorted_rows.filter(~ends).mapInArrow(run, "a long, b long, mask long"))
    return rows.repartition("key").sortWithinPartitions("key").mapInArrow(run, "a long, b long, mask long")


def links(nodes: DataFrame, radius: int = 3, segments: int = 2, bucket: int = BUCKET) -> DataFrame:
    """(a, b): links that connect nodes whose fingerprints differ in at most ``radius`` bits; ``nodes`` has node, fp0, …, all distinct.

    All such pairs meet, as ``radius < 2 * segments``.

    Inside a bucket only links that join something are returned, not all pairs.  A bucket with over ``bucket``
    members is cut by variants of the bits that it leaves free.  At radius 3 that leaves at most 33, 18 and 10 free bits
    after one, two and three cuts, so that no bucket has more than 1,024 distinct members then.
    """
    spark, names = nodes.sparkSession, nodes.columns[1:]
    width = len(names)
    masks = cuts(0, segments, width)
    rows, found = nodes, None
    owner, final = None, set()
    while True:
        # Which mask a variant belongs to is part of its key.
        if len(masks) >= 1 << MASK_BITS:
            raise ValueError("too many masks; raise the size of a bucket")
        listed = [(None if owner is None else owner[i], i, *_longs(m, width)) for i, m in enumerate(masks)]
        kinds = "mask long, nth long, " + ", ".join(f"m{k} long" for k in range(width))
        if owner is None:
            variant = F.explode(F.array(*[F.struct(F.lit(r[1]).alias("nth"), *[F.lit(v).alias(f"m{k}") for k, v in enumerate(r[2:])]) for r in listed]))
            varied = rows.select("*", variant.alias("v")).select("*", "v.*")
        else:
            varied = rows.join(F.broadcast(spark.createDataFrame(listed, kinds)), "mask")
        hashed = F.xxhash64("nth", *[F.col(n).bitwiseAND(F.col(f"m{k}")) for k, n in enumerate(names)])
        key = F.shiftleft(hashed, MASK_BITS).bitwiseOR(F.col("nth").cast("long"))
        level = settle(_bucket_links(varied.select(key.alias("key"), "node", *names), radius, bucket, final), "simhash-links")
        here = level.filter("b is not null").select("a", "b")
        found = here if found is None else found.unionByName(here)
        hot = level.filter("b is null").select(F.col("a").alias("node"), "mask").distinct()
        crowded = sorted(r[0] for r in hot.select("mask").distinct().collect())
        if not crowded:
            return found
        finer = [(m, x) for m in crowded for x in dict.fromkeys(cuts(masks[m], segments, width))]
        # A segment of one bit: leaving it out keeps nothing more, so such a bucket, of few members, is compared as it stands.
        final = {i for i, (m, x) in enumerate(finer) if x == masks[m]}
        owner, masks = [m for m, _ in finer], [x for _, x in finer]
        rows = hot.join(nodes, "node")


def _components(rows: DataFrame, radius: int, segments: int) -> DataFrame:
    """(fp0, …, component_id) for every fingerprint of the settled ``rows`` (id, fp0, …)."""
    names = rows.columns[1:]
    nodes = settle(rows.groupBy(*names).agg(F.min("id").alias("least")).withColumn("node", F.monotonically_increasing_id()), "fingerprint-nodes")
    roots = components(links(nodes.select("node", *names), radius, segments))
    grouped = nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    grouped = settle(grouped.select(*names, "root", "least"), "fingerprint-roots")
    least = grouped.groupBy("root").agg(F.min("least").alias("component_id"))
    return settle(grouped.join(least, "root").select(*names, "component_id"), "fingerprint-components")


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = 3, segments: int = 2) -> DataFrame:
    """One row per input row: id, fingerprint (16 hex digits), component_id (the smallest id reachable over links).

    Equal fingerprints are one node, so copies add nothing but a row each.  Rows without text share fingerprint
    zero.  Rows without an id get the smallest id of their group, null if there is none; repeated rows each get a row.
    """
    rows = settle(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    return rows.join(_components(rows, radius, segments), "fp0").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp0"), 16, "0")).alias("fingerprint"), "component_id"
    )


def met(nodes: DataFrame, radius: int, segments: int, bucket: int = BUCKET) -> DataFrame:
    """(a, b): pairs of ``nodes`` (node, fp0, …) that meet in a bucket of variants and differ in at most ``radius`` bits.

    Inside a bucket they connect what all such pairs do; in a crowded one they only tie its members to its first one.
    """
    names = nodes.columns[1:]
    masks = [(i, *_longs(m, len(names))) for i, m in enumerate(cuts(0, segments, len(names)))]
    variant = F.explode(F.array(*[F.struct(F.lit(m[0]).alias("nth"), *[F.lit(v).alias(f"m{k}") for k, v in enumerate(m[1:])]) for m in masks]))
    key = F.xxhash64("nth", *[F.col(n).bitwiseAND(F.col(f"m{k}")) for k, n in enumerate(names)])
    varied = nodes.select("*", variant.alias("v")).select("*", "v.*").select(key.alias("key"), "node", *names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub = None
        for now, crowded in _buckets(batches, bucket):
            if crowded:
                if hub is not None:
                    now = [np.concatenate(x) for x in zip(hub, now)]
                starts = np.flatnonzero(np.concatenate([[True], now[0][1:] != now[0][:-1]]))
                hub = [x[starts[-1] : starts[-1] + 1] for x in now]
                i = np.repeat(starts, np.diff(np.concatenate([starts, [len(now[0])]])))
                j = np.arange(len(i))
                near = (i < j) & (sum(np.bitwise_count((f[i] ^ f[j]).view(np.uint64)) for f in now[2:]) <= radius)
                i, j = i[near], j[near]
            else:
                i, j = _compare(now[0], [f.view(np.uint64) for f in now[2:]], radius)
            pairs = np.array(_union(zip(now[1][i].tolist(), now[1][j].tolist())), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

    return varied.repartition("key").sortWithinPartitions("key").mapInArrow(run, "a long, b long")


def drop_near_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, radius: int = 7, segments: int = 4, percent: int = 80
) -> DataFrame:
    """``docs`` without all but one document of each group of near copies: the one with the smallest id.

    Near copies are linked texts: those whose sets of shingles have a Jaccard similarity of at least ``percent`` hundredths.  Texts
    with equal sets are one node.  Fingerprints within ``radius`` bits, which is less than ``2 * segments``, give the first
    candidates: nearly all pairs of a similarity of 0.95, and fewer of less similar ones (two texts at 0.8 differ in about ten of 64 bits, and
    segments for that many would be too short to tell texts apart).  Texts that are not joined by then meet in the cells of
    :mod:`panelspark.llm.jaccard`, which lose no link.  Each link is checked on the sets themselves, so the groups are those of all pairs.

    Texts with no word have no shingle to compare and stay.  Of rows with the same id all stay or go together; a
    row without an id goes where a row with one is in its group.  Texts stay where they are unless the list of what goes is too
    large to broadcast.
    """

    def prints(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        return fingerprint_slice(data, offsets, shingle)[:, 0].view(np.int64)

    rows, nodes = jaccard.sets_and_nodes(docs, id_col, text_col, shingle, percent, prints)
    near = met(nodes.select("node", F.col("extra").alias("fp0")), radius, segments)
    near = settle(near.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "near-pairs")
    known = jaccard.verified(near, nodes, docs, text_col, shingle, percent)
    grouped = jaccard.named_groups(rows, nodes, jaccard.linked(docs, nodes, text_col, shingle, percent, known=known))
    gone = grouped.filter((F.col("n") > 0) & ~F.col("id").eqNullSafe(F.col("component_id")))
    gone = settle(gone.select(F.col("id").alias("_gone")).distinct(), "near-copies", rows=rows.count())
    return docs.join(gone, docs[id_col].eqNullSafe(gone["_gone"]), "left_anti")
