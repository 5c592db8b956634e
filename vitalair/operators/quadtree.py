"""Adaptive cells of the plane: a quadtree whose leaves split where drawn points are dense.

A tree is fitted on a bounded draw of points, so the driver holds no more than
that.  A node splits while it has more than 1 / SHARES of the draw, which leaves
at most DEPTH x SHARES x 3 + 1 leaves however large the data are.  Leaves are
numbered in Morton order: a point finds its own by a binary search, and boxes
meet the leaves they touch by an equi-join on cells of a fitting size.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEPTH, DRAW, SHARES = 20, 20_000, 400
SIDE = 1 << DEPTH


class Tree(NamedTuple):
    west: float
    south: float
    width: float
    height: float
    starts: list[int]  # Morton code of each leaf's first place
    levels: list[int]


def _spread(v: Column) -> Column:
    """Bits of a number below 2^DEPTH, one place apart."""
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        v = F.shiftleft(v, shift).bitwiseOR(v).bitwiseAND(F.lit(mask))
    return v


def _gathered(code: int) -> tuple[int, int]:
    """Column and row of a Morton code."""
    return tuple(sum((code >> (2 * k + d) & 1) << k for k in range(DEPTH)) for d in (0, 1))


def _morton(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    out = np.zeros(len(x), dtype=np.int64)
    for k in range(DEPTH):
        out |= ((x >> k & 1) << (2 * k)) | ((y >> k & 1) << (2 * k + 1))
    return out


def fitted(points: DataFrame, x: str, y: str, draw: int = DRAW, shares: int = SHARES) -> Tree | None:
    """The tree of points' places, from about `draw` of them (twice as many at most); None if there are none."""
    n, west, south, east, north = points.agg(F.count("*"), F.min(x), F.min(y), F.max(x), F.max(y)).first()
    if not n:
        return None
    width, height = max(east - west, 1e-9) * (1 + 1e-9), max(north - south, 1e-9) * (1 + 1e-9)
    rows = points.select(F.col(x).cast("double"), F.col(y).cast("double")).sample(min(1.0, draw / n), seed=7).limit(2 * draw).collect()
    at = np.array([tuple(r) for r in rows], dtype=float).reshape(-1, 2)
    cell = lambda v, lo, span: np.clip(np.floor((v - lo) / span * SIDE), 0, SIDE - 1).astype(np.int64)
    codes = np.sort(_morton(cell(at[:, 0], west, width), cell(at[:, 1], south, height)))
    leaves, todo = [], [(0, 0)]
    while todo:
        start, level = todo.pop()
        size = 4 ** (DEPTH - level)
        if level < DEPTH and np.diff(np.searchsorted(codes, [start, start + size]))[0] * shares > len(codes):
            todo += [(start + k * size // 4, level + 1) for k in range(4)]
        else:
            leaves.append((start, level))
    leaves.sort()
    return Tree(west, south, width, height, [s for s, _ in leaves], [v for _, v in leaves])


def _cell(tree: Tree, c: Column, axis: int) -> Column:
    lo, span = ((tree.west, tree.width), (tree.south, tree.height))[axis]
    return F.greatest(F.lit(0), F.least(F.lit(SIDE - 1), F.floor((c - lo) / span * SIDE)))


def with_leaf(df: DataFrame, tree: Tree, x: str, y: str) -> DataFrame:
    """df with the number `leaf` of each place's leaf; places outside the tree's box have the nearest one's."""
    code = _spread(_cell(tree, F.col(x), 0)).bitwiseOR(F.shiftleft(_spread(_cell(tree, F.col(y), 1)), 1))
    if len(tree.starts) == 1:
        return df.withColumn("leaf", F.lit(0))
    search = Bucketizer(splits=[*map(float, tree.starts), float(4**DEPTH)], inputCol="_code", outputCol="_leaf")
    return search.transform(df.withColumn("_code", code.cast("double"))).withColumn("leaf", F.col("_leaf").cast("int")).drop("_code", "_leaf")


def _leaves(df: DataFrame, tree: Tree) -> DataFrame:
    """(leaf, level, col, row, west, south, east, north): a bounded table."""
    rows = []
    for i, (start, level) in enumerate(zip(tree.starts, tree.levels)):
        c, r = _gathered(start)
        unit = 1 << (DEPTH - level)
        edge = [tree.west + c / SIDE * tree.width, tree.south + r / SIDE * tree.height, tree.west + (c + unit) / SIDE * tree.width, tree.south + (r + unit) / SIDE * tree.height]
        rows.append((i, level, c // unit, r // unit, *edge))
    return df.sparkSession.createDataFrame(rows, "leaf int, level int, col long, row long, west double, south double, east double, north double")


def touched(boxes: DataFrame, tree: Tree, low_x: Column, high_x: Column, low_y: Column, high_y: Column) -> DataFrame:
    """The different boxes with leaf and its edges (west, south, east, north): a row for each leaf that a box touches, never less.

    A box is dealt to the cells, four at most, of the level at which it is no wider
    than a cell. Leaves below such a cell have it among their ancestors; leaves
    above it are found under the cell's own ancestors.
    """
    own = list(boxes.columns)
    at = [_cell(tree, c, axis) for c, axis in ((low_x, 0), (high_x, 0), (low_y, 1), (high_y, 1))]
    grid = boxes.withColumns({n: F.greatest(F.lit(0), F.least(F.lit(SIDE - 1), c + d)) for c, d, n in zip(at, (-1, 1, -1, 1), ("_x0", "_x1", "_y0", "_y1"))})
    span = F.greatest(F.col("_x1") - F.col("_x0"), F.col("_y1") - F.col("_y0")) + 1
    grid = grid.withColumn("_level", F.greatest(F.lit(0), F.lit(DEPTH) - F.ceil(F.log2(span.cast("double")))).cast("int"))
    part = lambda c, a, b: F.floor(F.col(c) / F.pow(F.lit(2.0), F.col(a) - F.col(b)))
    grid = grid.withColumn("_depth", F.lit(DEPTH))
    every = lambda c: F.explode(F.sequence(part(f"{c}0", "_depth", "_level"), part(f"{c}1", "_depth", "_level")))
    cells = grid.withColumn("_col", every("_x")).withColumn("_row", every("_y")).withColumn("_at", F.explode(F.sequence(F.lit(0), F.col("_level"))))
    keys = cells.select(*own, "_at", (F.col("_at") < F.col("_level")).alias("_above"), part("_col", "_level", "_at").alias("_c"), part("_row", "_level", "_at").alias("_r"))
    leaves = _leaves(boxes, tree).withColumn("_at", F.explode(F.sequence(F.lit(0), F.col("level"))))
    leaves = leaves.withColumn("_above", F.explode(F.when(F.col("_at") == F.col("level"), F.array(F.lit(True), F.lit(False))).otherwise(F.array(F.lit(False)))))
    leaves = leaves.select("leaf", "west", "south", "east", "north", "_at", "_above", part("col", "level", "_at").alias("_c"), part("row", "level", "_at").alias("_r"))
    met = keys.join(F.broadcast(leaves), ["_at", "_above", "_c", "_r"])  # a row for each leaf and level above it: a bounded table
    return met.select(*own, "leaf", "west", "south", "east", "north").distinct()
