"""Exact k-nearest neighbours as a partitioned join.

Training rows are assigned to the nearest of about sqrt(n) pivots, or of fewer, so that a cell of long vectors has a block of rows: queries are
copied to each cell that they visit.  A first pass compares every query row with its nearest
cells only, just enough of them to hold k rows; its k-th distance there bounds how far any neighbour can be.  A second
pass visits the other cells that may hold a nearer row (triangle inequality).  Cells and queries are cut into blocks of
bounded size; one task compares one block of queries with one block of training rows and emits the k best per query, which
are merged by a group limit.  Training rows are copied only to blocks of queries that visit their cell.  Nothing is capped: a
cell that holds a third of the rows simply has more blocks.

Inside a task distances are first taken in single precision, whose error is bounded; only pairs that may be among the k best, given that
error, are compared exactly.  No matrix of a whole block is held.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

import numpy as np
import pandas as pd
from pyspark import Accumulator
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from panelspark.operators.rank import top_per_group
from panelspark.shipping import ship
from panelspark.tables import settle

#: Training rows of a block; a block of queries has ``CHUNK`` times as many.
BLOCK_ROWS, CHUNK = 4096, 4
#: Distances that are held at once inside a task.
_SLAB = 1 << 16
#: From this many columns on, products of matrices are faster than differences.
_PRODUCTS = 12
#: Rows of a cell at least, for each column; cells are made smaller until there are so many of them.
CELL_ROWS, PIVOTS = 64, 32


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.vstack([np.asarray(v, dtype=np.float64) for v in vectors])


def _between(a: np.ndarray, b: np.ndarray, metric: str) -> np.ndarray:
    """The distance of each row of ``a`` from the same row of ``b``."""
    gap = a - b
    return np.abs(gap).sum(axis=1) if metric == "manhattan" else np.sqrt((gap * gap).sum(axis=1))


def _sums(a: np.ndarray, columns: np.ndarray, metric: str) -> np.ndarray:
    """Sums of absolute or squared differences of the rows of ``a`` and of those whose ``columns`` are given, a column at a time."""
    out = np.zeros((len(a), columns.shape[1]), a.dtype)
    gap = np.empty_like(out)
    for j in range(a.shape[1]):
        np.subtract(columns[j], a[:, j : j + 1], out=gap)
        if metric == "manhattan":
            np.abs(gap, out=gap)
        else:
            np.multiply(gap, gap, out=gap)
        out += gap
    return out


def _distances(a: np.ndarray, b: np.ndarray, metric: str) -> np.ndarray:
    """All distances between the rows of two bounded blocks, a slab of rows at a time."""
    out, columns, step = np.empty((len(a), len(b))), np.ascontiguousarray(b.T), max(1, _SLAB // max(1, len(b)))
    for start in range(0, len(a), step):
        out[start : start + step] = _sums(a[start : start + step], columns, metric)
    return out if metric == "manhattan" else np.sqrt(out, out=out)


def _nearest(a: np.ndarray, b: np.ndarray, k: int, metric: str, limit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of a, row of b, distance) of the k nearest rows of ``b`` of each row of ``a``; equal distances go by the row of ``b``.

    Rows of ``b`` beyond the ``limit`` of a row of ``a`` may be left out.
    """
    found = []
    dims, step = a.shape[1], max(1, _SLAB // len(b))
    middle = b.mean(axis=0)
    scale = max(np.abs(a - middle).max(initial=0.0), np.abs(b - middle).max(initial=0.0))
    single = 1e-100 < scale < 1e100
    if single:
        # Of about size 1, so that single precision neither overflows nor loses small differences.
        short_a, short_b = ((x - middle) / scale for x in (a, b))
        l1 = metric == "manhattan"
        size_a, size_b = ((np.abs(x).sum(axis=1) if l1 else np.sqrt((x * x).sum(axis=1))) for x in (short_a, short_b))
        # More than rounding can take away from or add to a sum (of squares).
        error = (dims + 16) * 2.0**-22 * ((size_a + size_b.max()) if l1 else (size_a + size_b.max()) ** 2) + 1e-30
        short_a, columns = short_a.astype(np.float32), np.ascontiguousarray(short_b.T, dtype=np.float32)
        products = not l1 and dims >= _PRODUCTS
        if products:
            square_a, square_b = (size_a**2).astype(np.float32), (size_b**2).astype(np.float32)
        reach = limit / scale * (1 + 1e-9) if l1 else (limit / scale) ** 2 * (1 + 1e-9)
    groups = np.unique(np.linspace(0, len(b), min(len(b), max(128, 4 * k)), endpoint=False).astype(np.int64))
    for start in range(0, len(a), step):
        end = min(len(a), start + step)
        if single:
            if products:
                rough = short_a[start:end] @ columns
                rough *= -2
                rough += square_a[start:end, None]
                rough += square_b
            else:
                rough = _sums(short_a[start:end], columns, metric)
            bound = reach[start:end].copy()
            free = np.flatnonzero(~np.isfinite(bound))
            if len(free) and k <= len(groups):
                # The least of each of many groups: the k-th of these is not less than the k-th of all.
                least = np.minimum.reduceat(rough[free], groups, axis=1)
                bound[free] = np.partition(least, k - 1, axis=1)[:, k - 1] + error[start:end][free]
            i, j = np.nonzero(rough <= (bound + error[start:end])[:, None])
        else:
            i, j = (x.ravel() for x in np.indices((end - start, len(b))))
        distance = np.empty(len(i))
        for first in range(0, len(i), _SLAB):
            some = slice(first, first + _SLAB)
            distance[some] = _between(a[start + i[some]], b[j[some]], metric)
        order = np.lexsort((j, distance, i))
        i, j, distance = i[order], j[order], distance[order]
        place = np.arange(len(i)) - np.searchsorted(i, i)
        kept = place < k
        found.append((i[kept] + start, j[kept], distance[kept]))
    return tuple(np.concatenate(x) for x in zip(*found))


def _nearest_pivot(pivots: np.ndarray, metric: str):
    @F.pandas_udf("cell int, reach double")
    def nearest_pivot(vectors: pd.Series) -> pd.DataFrame:
        d = _distances(_matrix(vectors), pivots, metric)
        cell = d.argmin(axis=1)
        return pd.DataFrame({"cell": cell.astype("int32"), "reach": d[np.arange(len(d)), cell]})

    return nearest_pivot


def _nearest_cells(pivots: np.ndarray, ids: np.ndarray, sizes: np.ndarray, k: int, metric: str):
    """The nearest cells of a row, as many as it takes to hold ``k`` rows."""

    @F.pandas_udf(ArrayType(IntegerType()))
    def nearest_cells(vectors: pd.Series) -> pd.Series:
        d = _distances(_matrix(vectors), pivots[ids], metric)
        first = d.argmin(axis=1)
        out = [ids[c : c + 1].astype("int32") for c in first]
        # Most have enough in the nearest cell alone.
        for row in np.flatnonzero(sizes[first] < k):
            order = np.argsort(d[row], kind="stable")
            out[row] = ids[order[: (np.cumsum(sizes[order]) < k).sum() + 1]].astype("int32")
        return pd.Series(out)

    return nearest_cells


def _other_cells(pivots: np.ndarray, ids: np.ndarray, near: np.ndarray, far: np.ndarray, metric: str):
    """The cells not visited yet that may hold a row within the limit."""

    @F.pandas_udf(ArrayType(IntegerType()))
    def other_cells(vectors: pd.Series, visited: pd.Series, limit: pd.Series) -> pd.Series:
        d = _distances(_matrix(vectors), pivots[ids], metric)
        closest = np.maximum(np.maximum(d - far, near - d), 0.0)
        # The margin keeps rounding in the bounds from hiding a neighbour at exactly the limit.
        keep = closest <= (limit.fillna(np.inf).to_numpy() * (1 + 1e-9) + 1e-12)[:, None]
        return pd.Series([np.setdiff1d(ids[row], seen).astype("int32") for row, seen in zip(keep, visited)])

    return other_cells


def _best_in_cells(
    asked: DataFrame, placed: DataFrame, sizes: Mapping[int, int], k: int, metric: str, pairs: Accumulator | None
) -> DataFrame:
    """(key, neighbour, label, distance): for each row of ``asked`` (key, q, cell, limit) the k best of each block of its cell within the limit."""
    spark = asked.sparkSession
    # One row per cell that is visited; there are no more cells than pivots.
    visited = {r.cell: r.n for r in asked.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}
    cut = [(c, math.ceil(sizes[c] / BLOCK_ROWS), math.ceil(n / (CHUNK * BLOCK_ROWS))) for c, n in visited.items()]
    # A table for each side: both in one plan would be ambiguous.
    cut_left, cut_right = (F.broadcast(spark.createDataFrame(cut, "cell int, blocks int, chunks int")) for _ in range(2))

    def number(key: str, of: str) -> Column:
        return F.pmod(F.xxhash64(key), F.col(of)).cast("int")

    left = asked.join(cut_left, "cell").withColumn("chunk", number("key", "chunks"))
    left = left.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    right = placed.join(cut_right, "cell").withColumn("block", number("neighbour", "blocks"))
    right = right.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    types = dict(placed.dtypes)
    schema = f"key {dict(asked.dtypes)['key']}, neighbour {types['neighbour']}, label {types['label']}, distance double"

    def best_of_block(asked: pd.DataFrame, offered: pd.DataFrame) -> pd.DataFrame:
        if asked.empty or offered.empty:
            return pd.DataFrame({"key": asked["key"][:0], "neighbour": [], "label": [], "distance": []})
        if pairs is not None:
            pairs.add(len(asked) * len(offered))
        offered = offered.sort_values("neighbour", kind="stable")
        limit = asked["limit"].fillna(np.inf).to_numpy(np.float64)
        i, j, distance = _nearest(_matrix(asked["q"]), _matrix(offered["v"]), k, metric, limit)
        return pd.DataFrame(
            {
                "key": asked["key"].to_numpy()[i],
                "neighbour": offered["neighbour"].to_numpy()[j],
                "label": offered["label"].to_numpy()[j],
                "distance": distance,
            }
        )

    pairing = ["cell", "block", "chunk"]
    return left.groupBy(*pairing).cogroup(right.groupBy(*pairing)).applyInPandas(best_of_block, schema)


def neighbours(
    train: DataFrame,
    queries: DataFrame,
    key: str,
    vector: str,
    label: str,
    k: int,
    metric: str = "manhattan",
    pairs: Accumulator | None = None,
) -> DataFrame:
    """(key, neighbour, label, distance, position) of the k nearest training rows of every query row.

    ``metric`` is "manhattan" or "euclidean"; equal distances are ordered by the neighbour's key.  ``pairs`` counts the
    distances that are computed.
    """
    if metric not in ("manhattan", "euclidean"):
        raise ValueError(f"unknown metric {metric!r}")
    ship(train.sparkSession)
    rows = train.select(F.col(key).alias("neighbour"), F.col(label).alias("label"), F.col(vector).alias("v"))
    sought = queries.select(F.col(key).alias("key"), F.col(vector).alias("q"))

    # The pivots are training rows, spread by hash; their number grows with the square root of the rows at most.
    # Copies of short vectors cost little, so their cells are smaller.
    shape = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("columns")).first()
    cell_rows = min(BLOCK_ROWS, CELL_ROWS * (shape.columns or 1))
    wanted = max(1, min(math.isqrt(shape.n), max(shape.n // cell_rows, PIVOTS)))
    picked = rows.select("v", "neighbour").orderBy(F.xxhash64("neighbour"), "neighbour").limit(wanted).collect()
    if not picked:
        raise ValueError("there are no training rows")
    pivots = np.array([r.v for r in picked], dtype=np.float64)
    placed = rows.withColumn("place", _nearest_pivot(pivots, metric)("v"))
    placed = settle(placed.select("neighbour", "label", "v", "place.cell", "place.reach"), "knn-train")
    cells = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.min("reach").alias("near"), F.max("reach").alias("far"))
    cells = sorted(cells.collect(), key=lambda r: r.cell)
    ids, near, far = (np.array([r[c] for r in cells]) for c in ("cell", "near", "far"))
    sizes = {r.cell: r.n for r in cells}

    first = sought.withColumn("visited", _nearest_cells(pivots, ids, np.array([sizes[c] for c in ids]), k, metric)("q"))
    first = settle(first, "knn-first")
    order = [F.asc("distance"), F.asc("neighbour")]
    unbounded = F.lit(None).cast("double").alias("limit")
    begun = _best_in_cells(first.select("key", "q", F.explode("visited").alias("cell"), unbounded), placed, sizes, k, metric, pairs)
    begun = settle(top_per_group(begun, ["key"], order, k), "knn-begun")
    limits = begun.groupBy("key").agg(F.when(F.count(F.lit(1)) >= k, F.max("distance")).alias("limit"))
    more = first.join(limits, "key").withColumn("cell", F.explode(_other_cells(pivots, ids, near, far, metric)("q", "visited", "limit")))
    more = settle(more.select("key", "q", "cell", "limit"), "knn-more")
    rest = _best_in_cells(more, placed, sizes, k, metric, pairs)
    best = top_per_group(begun.unionByName(rest), ["key"], order, k, rank_as="position")
    return best.withColumnRenamed("key", key)


def _weights(scheme: str, key: str) -> Column:
    if scheme == "uniform":
        return F.lit(1.0)
    # Inverse distance; exact hits outvote everything else.
    exact = F.min("distance").over(Window.partitionBy(key)) == 0
    return F.when(exact, (F.col("distance") == 0).cast("double")).otherwise(1.0 / F.col("distance"))


def predict(
    train: DataFrame,
    queries: DataFrame,
    key: str,
    vector: str,
    label: str,
    k: int = 2,
    metric: str = "manhattan",
    weights: str = "uniform",
) -> DataFrame:
    """(key, prediction): vote of the k nearest training rows; ties go to the smallest label."""
    found = neighbours(train, queries, key, vector, label, k, metric).withColumn("w", _weights(weights, key))
    scores = found.groupBy(key, "label").agg(F.sum("w").alias("score"))
    return scores.groupBy(key).agg(
        F.min_by("label", F.struct(-F.col("score"), F.col("label"))).alias("prediction")
    )
