"""All forests of a grid in one growth: every tree of every fold is grown once, to its full depth.

What a node tries depends on its tree and its place alone.  So a smaller forest is the first trees of a larger one, a shallower tree the
upper levels of a deeper one, and a tree that needs more rows to split is the same tree with its small nodes closed.  One growth serves
every cell of the grid: rows to be judged go down with the rows learnt from, and for each cell stop at the first node that it does not split.

Features are cut into at most ``BINS`` bins at quantiles of the training rows.  A node tries about sqrt(features) of them, chosen by digest,
and takes the split with the least Gini impurity; if none of these parts its rows it is a leaf.  A tree's sample has weights drawn
by digest from a Poisson distribution of mean 1, as drawing with replacement has for many rows.  A forest's answer is the class
with the largest mean share over its trees, the first one of equals.

Rows of equal bins take the same way down every tree, so a tree is grown over points: the different bins with the weights of their rows by
class.  Three features have 32,768 points at most, however many rows there are.  Nodes of more than ``LOCAL`` points are split level by level,
by one aggregate and one join over all trees; a node of fewer is grown to its end in one task, with all of ``CHUNK`` trees.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelspark.shipping import ship
from panelspark.tables import settle

BINS = 32
#: Points of a node that a task grows to its end, and trees that it grows at once, at most.
LOCAL, CHUNK = 1 << 16, 5
#: Rows of a point that one task draws the weights of, and draws of a task.
DRAWN_ROWS, DRAWS = 1 << 14, 1 << 24
#: Shares are added as whole millionths of millionths, so that the order of rows makes no difference.
SHARE = 1e12
#: Levels of a tree without a limit; a node's number (twice its parent's, or one more) fits into a long.
DEEPEST = 60
NODE = ["forest", "tree", "node"]


@dataclass(frozen=True)
class Cell:
    """A forest of the grid: number of trees, levels (0: no limit), least rows of a node that is split."""

    trees: int
    depth: int
    split: int


def cells_of(grid: dict[str, Sequence[int]]) -> list[Cell]:
    return [Cell(t, d, s) for t in grid["trees"] for d in grid["depth"] for s in grid["split"]]


def binned(rows: DataFrame, features: int) -> DataFrame:
    """``rows`` with ``bins``: for each element of ``v`` how many quantiles of the training rows are less.  The quantiles are a few numbers."""
    shares = [k / BINS for k in range(1, BINS)]
    found = rows.filter("part = 'train'").agg(*[F.percentile_approx(F.col("v")[j], shares, 10_000).alias(f"q{j}") for j in range(features)]).first()
    edges = [sorted(set(q or [])) for q in found]

    def bin_of(j: int) -> Column:
        bounds = F.array(*[F.lit(float(e)) for e in edges[j]]).cast("array<double>")
        return F.size(F.filter(bounds, lambda e: e < F.col("v")[j])).cast("tinyint")

    return rows.withColumn("bins", F.array(*[bin_of(j) for j in range(features)]))


def _weight(seed: int) -> Column:
    """A number of draws, Poisson of mean 1, by digest of row, forest and tree."""
    uniform = F.pmod(F.xxhash64("key", "forest", "tree", F.lit(seed)), F.lit(1 << 52)) / float(1 << 52)
    total, steps = 0.0, []
    for k in range(12):
        total += math.exp(-1) / math.factorial(k)
        steps.append((uniform >= total).cast("int"))
    return reduce(lambda a, b: a + b, steps)


def _gini(counts: Sequence[Column], total: Column) -> Column:
    return F.lit(1.0) - reduce(lambda a, b: a + b, [(c / total) * (c / total) for c in counts])


def _best_splits(state: DataFrame, features: int, classes: int, seed: int) -> DataFrame:
    """(forest, tree, node, rows, n, shares, feature, bin, gain) for every node: its training rows, and its best split (gain 0: none)."""
    tried = max(1, math.isqrt(features))
    ranked = F.array_sort(F.array(*[F.struct(F.xxhash64(*NODE, F.lit(j), F.lit(seed)).alias("by"), F.lit(j).alias("feature")) for j in range(features)]))
    names = [f"c{c}" for c in range(classes)]
    bins = F.array(*[F.col(f"b{j}") for j in range(features)]).alias("bins")
    chosen = state.filter("rows > 0").select(*NODE, "rows", *names, bins, F.explode(F.slice(ranked, 1, tried)).alias("r"))
    chosen = chosen.select(*NODE, "rows", *names, F.col("r.feature").alias("feature"), F.expr("bins[r.feature]").alias("bin"))
    counts = chosen.groupBy(*NODE, "feature", "bin").agg(F.sum("rows").alias("rows"), *[F.sum(c).alias(c) for c in names])
    part = Window.partitionBy(*NODE, "feature")
    upto = part.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    # At most BINS rows for each node and feature.
    cumulated = counts.select(
        *NODE, "feature", "bin", F.sum("rows").over(part).alias("rows"),
        *[F.sum(c).over(upto).alias(f"left_{c}") for c in names], *[F.sum(c).over(part).alias(f"all_{c}") for c in names],
    )
    left, every = [F.col(f"left_{c}") for c in names], [F.col(f"all_{c}") for c in names]
    right = [a - b for a, b in zip(every, left)]
    n_left, n = (reduce(lambda a, b: a + b, x) for x in (left, every))
    n_right = n - n_left
    gain = F.when(n_right > 0, _gini(every, n) - (n_left * _gini(left, n_left) + n_right * _gini(right, n_right)) / n).otherwise(0.0)
    # Rounded, so that equal gains are ties, which go to the first feature and the lowest bin.
    gain = F.greatest(F.round(gain, 10), F.lit(0.0))
    scored = cumulated.select(*NODE, "rows", n.alias("n"), F.array(*[a / n for a in every]).alias("shares"), "feature", "bin", gain.alias("gain"))
    best = F.max_by(F.struct("feature", "bin"), F.struct("gain", -F.col("feature"), -F.col("bin"))).alias("best")
    found = scored.groupBy(*NODE).agg(F.max("rows").alias("rows"), F.max("n").alias("n"), F.max("shares").alias("shares"), F.max("gain").alias("gain"), best)
    return found.select(*NODE, "rows", "n", "shares", "gain", "best.feature", "best.bin")


def _digest(*values: np.ndarray | int) -> np.ndarray:
    """``F.xxhash64`` of whole numbers: a numpy array of longs as such, any other as an int."""
    u = np.uint64
    p1, p2, p3, p4, p5 = (u(p) for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))

    def turned(x, k: int):
        return (x << u(k)) | (x >> u(64 - k))

    found = np.array([42], u)
    with np.errstate(over="ignore"):
        for v in values:
            if getattr(v, "dtype", None) == np.int64:
                h = turned((found + p5 + u(8)) ^ (turned(v.view(u) * p2, 31) * p1), 27) * p1 + p4
            else:
                h = turned((found + p5 + u(4)) ^ (np.atleast_1d(v).astype(np.int32).view(np.uint32).astype(u) * p1), 23) * p2 + p3
            h = (h ^ (h >> u(33))) * p2
            h = (h ^ (h >> u(29))) * p3
            found = h ^ (h >> u(32))
    return found.view(np.int64)


def _impurity(counts: np.ndarray, total: np.ndarray) -> np.ndarray:
    shares = counts / total[:, None]
    return 1.0 - reduce(lambda a, b: a + b, (shares * shares).T)


def _split(bins: np.ndarray, counts: np.ndarray, of: np.ndarray, every: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(gain, bin) of the best cut of each node by one feature; points are in the order of their nodes ``of``, whose sums are ``every``."""
    order = np.argsort(of * BINS + bins, kind="stable")
    bins, of = bins[order], of[order]
    sums = np.cumsum(counts[order], axis=0)
    starts = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
    before = np.concatenate([np.zeros((1, counts.shape[1]), np.int64), sums])[starts]
    last = np.flatnonzero(np.concatenate([(of[1:] != of[:-1]) | (bins[1:] != bins[:-1]), [True]]))
    node = of[last]
    left = sums[last] - before[node]
    right = every[node] - left
    n_left, n_right, n = left.sum(axis=1), right.sum(axis=1), every.sum(axis=1)[node]
    gain = np.zeros(len(last))
    some = (n_left > 0) & (n_right > 0)
    parts = n_left[some] * _impurity(left[some], n_left[some]) + n_right[some] * _impurity(right[some], n_right[some])
    gain[some] = np.maximum(np.floor((_impurity(every[node[some]], n[some]) - parts / n[some]) * 1e10 + 0.5) / 1e10, 0.0)
    best = np.lexsort((bins[last], -gain, node))
    best = best[np.flatnonzero(np.concatenate([[True], node[best][1:] != node[best][:-1]]))]
    return gain[best], bins[last][best]


def _grow_nodes(given: pd.DataFrame, features: int, classes: int, shapes: list[tuple[int, int]], seed: int) -> pd.DataFrame:
    """Grows one node of some trees of a forest to its end: rows of ``_GROWN``, for every node below it and for every point that is judged."""
    forest = int(given["forest"].iloc[0])
    tree, node, p = (given[c].to_numpy() for c in ("tree", "node", "p"))
    rows, still = given["rows"].to_numpy(), given["open"].to_numpy().copy()
    bins = given[[f"b{j}" for j in range(features)]].to_numpy().astype(np.int64)
    counts = given[[f"c{c}" for c in range(classes)]].to_numpy()
    asked = still != 0
    votes = np.zeros((len(p), len(shapes), classes), np.int64)
    tried = max(1, math.isqrt(features))
    level, live, nodes = int(node[0]).bit_length() - 1, np.arange(len(p)), []
    while len(live):
        live = live[np.lexsort((node[live], tree[live]))]
        first = np.concatenate([[True], (np.diff(tree[live]) != 0) | (np.diff(node[live]) != 0)])
        of, starts = np.cumsum(first) - 1, np.flatnonzero(first)
        trees, at = tree[live][starts], node[live][starts]
        every, held = np.add.reduceat(counts[live], starts), np.add.reduceat(rows[live], starts)
        n = every.sum(axis=1)
        ranks = np.stack([_digest(forest, trees.astype(np.int32), at, j, seed) for j in range(features)])
        chosen = np.sort(np.argsort(ranks, axis=0, kind="stable")[:tried], axis=0)
        gain, feature, cut = np.full(len(at), -1.0), np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        for by in chosen:
            its_gain, its_cut = _split(bins[live, by[of]], counts[live], of, every)
            more = its_gain > gain
            gain, feature, cut = np.where(more, its_gain, gain), np.where(more, by, feature), np.where(more, its_cut, cut)
        # A tree that no row was drawn for has no node.
        some = n > 0
        nodes.append(pd.DataFrame({"tree": trees, "node": at, "rows": held, "n": n, "gain": gain, "feature": feature, "bin": cut, "level": level})[some])
        leaf = (gain == 0) | (level == DEEPEST)
        closed = np.zeros(len(at), np.int64)
        for k, (d, s) in enumerate(shapes):
            closed |= np.where(leaf | (d > 0 and level >= d) | (held < s), 1 << k, 0)
        shares = np.floor(every / np.maximum(n, 1)[:, None] * SHARE + 0.5).astype(np.int64)
        now = closed[of] & still[live]
        for k in range(len(shapes)):
            ends = (now >> k & 1).astype(bool)
            votes[live[ends], k] = shares[of[ends]]
        still[live] ^= now
        on = (~leaf[of] & (rows[live] > 0)) | (still[live] != 0)
        live, of = live[on], of[on]
        node[live] = node[live] * 2 + (bins[live, feature[of]] > cut[of])
        level += 1
    # The votes of these trees for a point are one row.
    points, owner = np.unique(p[asked], return_inverse=True)
    added = np.zeros((len(points), len(shapes) * classes), np.int64)
    np.add.at(added, owner, votes[asked].reshape(-1, len(shapes) * classes))
    grown = pd.concat(nodes).assign(p=pd.NA, votes=None)
    said = pd.DataFrame({"tree": np.full(len(points), tree.max()), "p": points, "votes": list(added)})
    return pd.concat([grown.astype({"p": "Int64"}), said.astype({"p": "Int64"})]).assign(forest=forest)[[c.split()[0] for c in _GROWN]].astype(
        {c.split()[0]: "Int64" for c in _GROWN if c.endswith(("int", "long"))}
    )


#: Rows of the growth: a node (without ``p`` and ``votes``), or how much some trees up to ``tree`` give each shape and class for the point ``p``.
_GROWN = ["forest int", "tree int", "node long", "rows long", "n long", "gain double", "feature int", "bin int", "level int", "p long", "votes array<long>"]
_NODES = ["forest", "tree", "node", "rows", "n", "gain", "feature", "bin", "level"]


@dataclass(frozen=True)
class Grown:
    """``nodes``: every node of every tree with its level; ``votes``: shares given to each point by shape (depth and split) of the grid;
    ``asked``: the point of each row that is judged, and the forest that judges it."""

    nodes: DataFrame
    votes: DataFrame
    asked: DataFrame
    shapes: list[tuple[int, int]]


def _drawn(rows: DataFrame, folds: int, classes: int, trees: int, seed: int) -> DataFrame:
    """(forest, tree, p, rows, c0 …, judged) for every point that a tree learns from or judges; ``rows``: (key, idx, part, fold, p, share)."""
    spread = rows.select("key", "idx", "part", "fold", "p", F.explode(F.sequence(F.lit(0), F.lit(folds))).alias("forest"))
    whole = F.col("forest") == folds
    learns = (F.col("part") == "train") & (whole | (F.col("fold") != F.col("forest")))
    judged = F.when(F.col("part") == "test", whole).otherwise(~whole & (F.col("fold") == F.col("forest")))
    spread = spread.select("key", "idx", "p", "forest", learns.alias("learns"), judged.alias("judged")).filter("learns or judged")
    spread = spread.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))))
    drawn = spread.select("forest", "tree", "p", "idx", "judged", F.when(F.col("learns"), _weight(seed)).otherwise(0).alias("weight"))
    sums = [F.sum(F.when(F.col("idx") == c, F.col("weight")).otherwise(0)).alias(f"c{c}") for c in range(classes)]
    return drawn.filter("weight > 0 or judged").groupBy("forest", "tree", "p").agg(
        F.count_if(F.col("weight") > 0).alias("rows"), *sums, F.max("judged").alias("judged")
    )


def grow(rows: DataFrame, folds: int, features: int, classes: int, grid: dict[str, Sequence[int]], seed: int = 42) -> Grown:
    """Grows ``max(trees)`` trees for each fold without it, and as many on all training rows (forest number ``folds``).

    ``rows``: (key, idx, part, fold, bins).  Rows of a fold are judged by its forest, those of part ``test`` by the one of all training rows.
    """
    spark = rows.sparkSession
    ship(spark)
    shapes = [(d, s) for d in grid["depth"] for s in grid["split"]]
    trees = max(grid["trees"])
    # Trees of one task are all in a forest of the grid, or none is.
    chunk = max(k for k in range(1, CHUNK + 1) if all(t % k == 0 for t in grid["trees"]))
    points = rows.groupBy("bins").agg(F.count(F.lit(1)).alias("held")).withColumn("p", F.monotonically_increasing_id())
    points = settle(points, "forest-points")
    sizes = points.agg(F.count(F.lit(1)).alias("points"), F.sum("held").alias("rows")).first()
    placed = settle(rows.join(points, "bins").select("key", "idx", "part", "fold", "p", "held"), "forest-rows")
    # Rows of a point meet before their weights are drawn, those of a common point in several tasks.
    share = F.pmod(F.xxhash64("key", F.lit("share")), F.ceil(F.col("held") / DRAWN_ROWS))
    tasks = max(spark.sparkContext.defaultParallelism, math.ceil((sizes.rows or 0) * trees * (folds + 1) / DRAWS))
    dealt = placed.withColumn("share", share).repartition(tasks, "p", "share")
    drawn = _drawn(dealt, folds, classes, trees, seed)
    bins = [F.col("bins")[j].cast("int").alias(f"b{j}") for j in range(features)]
    counts = [f"c{c}" for c in range(classes)]
    # One bit for each shape whose forests the point still goes down in.
    still = F.when(F.col("judged"), (1 << len(shapes)) - 1).otherwise(0).cast("bigint").alias("open")
    state = drawn.join(points.select("p", *bins), "p").select(
        "forest", "tree", F.lit(1).cast("bigint").alias("node"), "p", "rows", *counts, still, *[f"b{j}" for j in range(features)]
    )
    state = settle(state, "forest-state")
    found, small = [], [state]
    if (sizes.points or 0) > LOCAL:
        found, small = _upper_levels(state, features, classes, shapes, seed)

    def local(given: pd.DataFrame) -> pd.DataFrame:
        return _grow_nodes(given, features, classes, shapes, seed)

    pieces = reduce(DataFrame.unionByName, small).withColumn("chunk", F.floor(F.col("tree") / chunk))
    pieces = pieces.repartition(4 * spark.sparkContext.defaultParallelism, "forest", "chunk", "node")
    grown = settle(pieces.groupBy("forest", "chunk", "node").applyInPandas(local, ", ".join(_GROWN)), "forest-grown")
    found.append(grown)
    whole = reduce(DataFrame.unionByName, found)
    asked = placed.select("key", "idx", F.when(F.col("part") == "test", folds).otherwise(F.col("fold")).alias("forest"), "p")
    return Grown(whole.filter("p is null").select(*_NODES), whole.filter("p is not null").select("forest", "tree", "p", "votes"), asked, shapes)


def _upper_levels(state: DataFrame, features: int, classes: int, shapes: list[tuple[int, int]], seed: int) -> tuple[list[DataFrame], list[DataFrame]]:
    """(rows of ``_GROWN``, points of nodes that a task can grow): splits nodes of more than ``LOCAL`` points, a level at a time."""
    found, small = [], []
    for level in range(DEEPEST + 1):
        sized = state.groupBy(*NODE).agg(F.count(F.lit(1)).alias("points"))
        crowded = settle(sized.filter(F.col("points") > LOCAL).select(*NODE), "forest-crowded")
        small.append(state.join(crowded, NODE, "left_anti"))
        state = state.join(crowded, NODE)
        if crowded.isEmpty():
            break
        best = settle(_best_splits(state, features, classes, seed).withColumn("level", F.lit(level)), "forest-nodes")
        leaf = F.lit(level == DEEPEST) | (F.col("gain") == 0)
        closed = [F.when(leaf | F.lit(d > 0 and level >= d) | (F.col("held") < s), 1 << k).otherwise(0) for k, (d, s) in enumerate(shapes)]
        joined = state.join(best.withColumnRenamed("rows", "held"), NODE)
        joined = joined.withColumn("closed", reduce(lambda a, b: a.bitwiseOR(b), closed).cast("bigint").bitwiseAND(F.col("open")))
        down = F.when(F.array(*[F.col(f"b{j}") for j in range(features)])[F.col("feature")] > F.col("bin"), 1).otherwise(0)
        said = [
            F.when(F.col("closed").bitwiseAND(1 << k) != 0, F.round(F.col("shares")[c] * SHARE).cast("bigint")).otherwise(0)
            for k in range(len(shapes)) for c in range(classes)
        ]
        moved = joined.select(
            "forest", "tree", "p", (F.col("node") * 2 + down).alias("node"), "rows", *[f"c{c}" for c in range(classes)],
            *[f"b{j}" for j in range(features)], F.col("open").bitwiseXOR(F.col("closed")).alias("open"), leaf.alias("leaf"), "closed",
            F.when(F.col("closed") != 0, F.array(*said)).alias("votes"),
        )
        moved = settle(moved, "forest-state")
        empty = {c.split()[0]: F.lit(None).cast(c.split()[1]) for c in _GROWN}
        names = list(empty)
        found.append(best.withColumns({c: empty[c] for c in ("p", "votes")}).select(*names))
        stopped = moved.filter("closed <> 0").select("forest", "tree", "p", "votes")
        found.append(stopped.withColumns({c: empty[c] for c in names if c not in stopped.columns}).select(*names))
        state = moved.filter("(not leaf and rows > 0) or open <> 0").drop("leaf", "closed", "votes")
    return found, small


def _predicted(grown: Grown, classes: int, grid: dict[str, Sequence[int]]) -> DataFrame:
    """(forest, trees, depth, split, p, predicted) for every judged point and cell."""
    forests = F.explode(F.filter(F.array(*[F.lit(t) for t in grid["trees"]]), lambda t: F.col("tree") < t)).alias("trees")
    sums = [F.sum(F.col("votes")[k]).alias(f"s{k}") for k in range(len(grown.shapes) * classes)]
    voted = grown.votes.select("forest", forests, "p", "votes").groupBy("forest", "trees", "p").agg(*sums)

    def answer(k: int) -> Column:
        order = F.array(*[F.struct(F.col(f"s{k * classes + c}").alias("s"), F.lit(-c).alias("less")) for c in range(classes)])
        return -F.array_max(order)["less"]

    shape = F.explode(F.array(*[
        F.struct(F.lit(d).alias("depth"), F.lit(s).alias("split"), answer(k).alias("predicted")) for k, (d, s) in enumerate(grown.shapes)
    ])).alias("shape")
    return voted.select("forest", "trees", "p", shape).select("forest", "trees", "shape.depth", "shape.split", "p", "shape.predicted")


def judged(grown: Grown, classes: int, grid: dict[str, Sequence[int]]) -> DataFrame:
    """(forest, trees, depth, split, key, idx, predicted) for every judged row and cell."""
    found = _predicted(grown, classes, grid).join(grown.asked, ["forest", "p"])
    return found.select("forest", "trees", "depth", "split", "key", "idx", "predicted")


def scores(grown: Grown, folds: int, classes: int, grid: dict[str, Sequence[int]]) -> DataFrame:
    """(trees, depth, split, fold, n_rows, accuracy) of every cell on every fold; fold ``folds``: the forest of all training rows on the test rows."""
    # Rows of one point and class are judged alike.
    alike = grown.asked.groupBy("forest", "p", "idx").agg(F.count(F.lit(1)).alias("held"))
    right = F.sum(F.when(F.col("predicted") == F.col("idx"), F.col("held")).otherwise(0))
    found = _predicted(grown, classes, grid).join(alike, ["forest", "p"]).groupBy("trees", "depth", "split", F.col("forest").alias("fold"))
    return found.agg(F.sum("held").alias("n_rows"), (right / F.sum("held")).alias("accuracy"))


def importances(grown: Grown, forest: int, cell: Cell, features: int) -> DataFrame:
    """(feature number, importance): a feature's share of the impurity that a tree's splits take away, on average over the trees of a cell."""
    of_cell = grown.nodes.filter((F.col("forest") == forest) & (F.col("tree") < cell.trees))
    split = of_cell.filter((F.col("gain") > 0) & (F.col("rows") >= cell.split))
    if cell.depth:
        split = split.filter(F.col("level") < cell.depth)
    by_tree = split.groupBy("tree", "feature").agg(F.sum(F.col("n") * F.col("gain")).alias("part"))
    shares = by_tree.withColumn("share", F.col("part") / F.sum("part").over(Window.partitionBy("tree")))
    by_feature = shares.groupBy("feature").agg(F.sum("share").alias("share"))
    # Trees without a split have no share to give.
    total = shares.agg(F.countDistinct("tree").alias("trees")).first().trees or 1
    listed = grown.nodes.sparkSession.range(features).select(F.col("id").cast("int").alias("feature"))
    return listed.join(by_feature, "feature", "left").select("feature", (F.coalesce("share", F.lit(0.0)) / total).alias("importance"))
