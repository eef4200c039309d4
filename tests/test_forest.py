"""Forests of a grid from one growth: split choice against brute force, and every cell equal to a forest grown for it alone."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelspark.ml import forest
from panelspark.ml.forest import Cell

KINDS = "key long, idx int, part string, fold int, v array<double>"


def rows_of(spark, n, features, classes=3, seed=4, folds=2):
    rng = random.Random(seed)
    out = []
    for k in range(n):
        v = [float(rng.randint(0, 12)) for _ in range(features)]
        idx = (int(v[0] > 5) + int(v[-1] > 8) + (rng.random() < 0.2)) % classes
        test = k % 5 == 0
        out.append((k, idx, "test" if test else "train", None if test else k % folds, v))
    return out, spark.createDataFrame(out, KINDS)


def gini(counts):
    total = sum(counts)
    return 1 - sum((c / total) ** 2 for c in counts)


def brute_tree(rows, classes):
    """{node: (rows, weight, bin or None)} of one tree over one feature; rows: (bin, class, weight)."""
    found = {}

    def visit(node, inside):
        total = [sum(w for _, c, w in inside if c == k) for k in range(classes)]
        best, at = 0.0, None
        for b in sorted({b for b, _, _ in inside})[:-1]:
            left = [sum(w for x, c, w in inside if c == k and x <= b) for k in range(classes)]
            right = [t - x for t, x in zip(total, left)]
            gain = round(gini(total) - (sum(left) * gini(left) + sum(right) * gini(right)) / sum(total), 10)
            if gain > best:
                best, at = gain, b
        found[node] = len(inside), sum(total), at
        if at is not None:
            visit(2 * node, [r for r in inside if r[0] <= at])
            visit(2 * node + 1, [r for r in inside if r[0] > at])

    visit(1, rows)
    return found


def test_splits_are_those_of_brute_force(spark):
    given, df = rows_of(spark, 90, 1)
    binned = forest.binned(df, 1)
    grid = {"trees": (3,), "depth": (0,), "split": (2,)}
    grown = forest.grow(binned, 2, 1, 3, grid)
    bins = {r.key: r.bins[0] for r in binned.collect()}
    edges = sorted({v[0] for *_, part, _, v in given if part == "train"})
    # Thirteen values: with this few, every one is a quantile.
    assert all(bins[k] == sum(e < v[0] for e in edges) for k, *_, v in given)
    pairs = binned.select("key", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("forest")).withColumn("tree", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))))
    weight = {(r.key, r.forest, r.tree): r.w for r in pairs.withColumn("w", forest._weight(42)).collect()}
    assert abs(sum(weight.values()) / len(weight) - 1) < 0.15
    got = {}
    for r in grown.nodes.collect():
        got.setdefault((r.forest, r.tree), {})[r.node] = (r.rows, r.n, r.bin if r.gain > 0 else None)
    for f in range(3):
        for t in range(3):
            sample = [(bins[k], c, weight[k, f, t]) for k, c, part, fold, _ in given if part == "train" and fold != f and weight[k, f, t]]
            assert got[f, t] == brute_tree(sample, 3)


def table(df):
    return sorted(tuple(r) for r in df.collect())


def test_each_cell_is_the_forest_grown_for_it(spark):
    _, df = rows_of(spark, 120, 5)
    binned = forest.binned(df, 5)
    grid = {"trees": (1, 4), "depth": (0, 2), "split": (2, 9)}
    whole = table(forest.judged(forest.grow(binned, 2, 5, 3, grid), 3, grid))
    cells = forest.cells_of(grid)
    assert len(cells) == 8 and len(whole) == 8 * 120
    for cell in (Cell(1, 0, 9), Cell(4, 2, 2), Cell(4, 2, 9)):
        alone = {"trees": (cell.trees,), "depth": (cell.depth,), "split": (cell.split,)}
        assert table(forest.judged(forest.grow(binned, 2, 5, 3, alone), 3, alone)) == [r for r in whole if r[1:4] == (cell.trees, cell.depth, cell.split)]
    by_fold = forest.scores(forest.grow(binned, 2, 5, 3, grid), 2, 3, grid).collect()
    assert len(by_fold) == 8 * 3 and {(r.fold, r.n_rows) for r in by_fold} == {(0, 48), (1, 48), (2, 24)}


def test_importances(spark):
    _, df = rows_of(spark, 200, 3, classes=2, seed=9)
    grid = {"trees": (6,), "depth": (3,), "split": (4,)}
    grown = forest.grow(forest.binned(df, 3), 2, 3, 2, grid)
    got = {r.feature: r.importance for r in forest.importances(grown, 2, Cell(6, 3, 4), 3).collect()}
    parts = {}
    for r in grown.nodes.filter("forest = 2").collect():
        if r.gain > 0 and r.rows >= 4 and r.level < 3:
            parts.setdefault(r.tree, {}).setdefault(r.feature, []).append(r.n * r.gain)
    shares = [{f: sum(p) for f, p in tree.items()} for tree in parts.values()]
    want = {f: sum(tree.get(f, 0) / sum(tree.values()) for tree in shares) / len(shares) for f in range(3)}
    assert got == pytest.approx(want) and sum(got.values()) == pytest.approx(1)
    one = df.withColumn("idx", F.lit(0))
    none = forest.grow(forest.binned(one, 3), 2, 3, 2, grid)
    assert {r.importance for r in forest.importances(none, 2, Cell(6, 3, 4), 3).collect()} == {0.0}
    assert {r.predicted for r in forest.judged(none, 2, grid).collect()} == {0}


def test_digests_are_those_of_spark(spark):
    df = spark.createDataFrame([(k, k * 7 - 3, k * 0x123456789AB - 5) for k in range(50)], "a int, b int, c long")
    given = df.withColumn("h", F.xxhash64("a", "b", "c", F.lit(2))).collect()
    a, b, c = (np.array([r[k] for r in given], kind) for k, kind in enumerate((np.int32, np.int32, np.int64)))
    assert forest._digest(a, b, c, 2).tolist() == [r.h for r in given]


def test_a_tree_is_the_same_whether_tasks_or_levels_grow_it(spark, monkeypatch):
    """Nodes of over 20 points are split by aggregates, those below them in a task; rows of common points draw their weights in several tasks."""
    _, df = rows_of(spark, 150, 4)
    binned = forest.binned(df, 4)
    grid = {"trees": (2, 4), "depth": (0, 3), "split": (2, 9)}
    columns = ["forest", "tree", "node", "rows", "n", "gain", "level"]
    found = []
    for local, drawn in ((1 << 16, 1 << 14), (20, 1)):
        monkeypatch.setattr(forest, "LOCAL", local)
        monkeypatch.setattr(forest, "DRAWN_ROWS", drawn)
        grown = forest.grow(binned, 2, 4, 3, grid)
        found.append((table(grown.nodes.select(*columns)), table(forest.judged(grown, 3, grid)), table(forest.scores(grown, 2, 3, grid))))
    assert found[0] == found[1] and len(found[0][1]) == 8 * 150


def test_growth_holds_points_not_rows(spark):
    """Thrice the rows with the same bins are as many points: work in the trees does not grow with the rows."""
    _, df = rows_of(spark, 100, 2)
    more = df.unionByName(df.withColumn("key", F.col("key") + 1000)).unionByName(df.withColumn("key", F.col("key") + 2000))
    grid = {"trees": (1,), "depth": (0,), "split": (2,)}
    points = [forest.grow(forest.binned(rows, 2), 2, 2, 3, grid).asked.select("p").distinct().count() for rows in (df, more)]
    assert points[0] == points[1] < 100
