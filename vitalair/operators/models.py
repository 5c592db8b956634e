"""Models on visit tables: bins, decision trees and feed-forward classifiers of pyspark.ml."""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, MultilayerPerceptronClassifier
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def age_bin(birth: Column, at: Column, edges: list[float]) -> Column:
    """Number of edges that the age in days / 365.25 has reached."""
    age = F.datediff(F.to_date(at), birth) / 365.25
    return sum((F.when(age >= e, 1).otherwise(0) for e in edges), F.lit(0))


def visit_count_bin(n: Column) -> Column:
    """0, 1, 2, and 3 for more."""
    return F.least(n, F.lit(3))


def fit_tree(visits: DataFrame, features: list[str], label: str, depth: int = 5) -> PipelineModel:
    """Decision tree on numeric features; label holds class numbers from 0."""
    stages = [VectorAssembler(inputCols=features, outputCol="_x", handleInvalid="keep"), DecisionTreeClassifier(featuresCol="_x", labelCol=label, predictionCol="predicted", maxDepth=depth, seed=7)]
    return Pipeline(stages=stages).fit(visits)


def fit_network(rows: DataFrame, features: list[str], labels: list[str], hidden: list[int], epochs: int = 100, batch: int = 128) -> PipelineModel:
    """Feed-forward classifier; `labels` are one-hot columns, the largest of which is the class."""
    kinds = F.array(*map(F.col, labels))
    classed = rows.withColumn("_label", (F.array_position(kinds, F.array_max(kinds)) - 1).cast("double"))
    stages = [
        VectorAssembler(inputCols=features, outputCol="_raw"), StandardScaler(inputCol="_raw", outputCol="_x", withMean=True),
        MultilayerPerceptronClassifier(featuresCol="_x", labelCol="_label", predictionCol="predicted", layers=[len(features), *hidden, len(labels)], maxIter=epochs, blockSize=batch, seed=7),
    ]
    return Pipeline(stages=stages).fit(classed)


def scored(model: PipelineModel, visits: DataFrame) -> DataFrame:
    """Every row with its predicted class number."""
    out = model.transform(visits)
    return out.select(*visits.columns, F.col("predicted").cast("int").alias("predicted"))


def scoring_rows(visits: DataFrame, before: DataFrame, exposure: DataFrame, flags: DataFrame, key: str, on: list[str], measure: str, default: float) -> DataFrame:
    """Visits ready for scoring: counts of the year before (0 without any), exposure (the default without any), one flag a code (false without any)."""
    named = [c for c in flags.columns if c != key]
    met = visits.join(before, key, "left").join(exposure, on, "left").join(flags, key, "left")
    met = met.withColumn(measure, F.coalesce(measure, F.lit(default)))
    return met.fillna(0, [c for c in before.columns if c != key]).fillna(False, named)


class Node(NamedTuple):
    """A node of a grown tree: training rows of each class, and below a split the side up to the threshold and the side beyond it."""

    counts: tuple[float, ...]
    feature: str | None = None
    threshold: float = 0.0
    left: Node | None = None
    right: Node | None = None

    @property
    def risk(self) -> float:
        """Rows that the most frequent class gets wrong."""
        return sum(self.counts) - max(self.counts)


def grown(visits: DataFrame, features: list[str], label: str, depth: int = 8, least: int = 7) -> Node:
    """A tree grown by Spark, `least` rows a leaf at least, as nodes: the driver holds 2^depth at most."""
    assembled = VectorAssembler(inputCols=features, outputCol="_x", handleInvalid="keep").transform(visits.where(F.col(label).isNotNull()))
    model = DecisionTreeClassifier(featuresCol="_x", labelCol=label, maxDepth=depth, minInstancesPerNode=least, seed=7).fit(assembled)

    def read(node) -> Node:
        counts = tuple(node.impurityStats().stats())
        if node.getClass().getSimpleName() != "InternalNode":
            return Node(counts)
        split = node.split()
        return Node(counts, features[split.featureIndex()], split.threshold(), read(node.leftChild()), read(node.rightChild()))

    return read(model._call_java("rootNode"))


def leaves(tree: Node) -> int:
    return 1 if tree.feature is None else leaves(tree.left) + leaves(tree.right)


def leaf_risk(tree: Node) -> float:
    return tree.risk if tree.feature is None else leaf_risk(tree.left) + leaf_risk(tree.right)


def pruned(tree: Node, cost: float) -> Node:
    """The smallest subtree with the least risk + cost x leaves: a split stays if what lies below it pays for its leaves."""
    if tree.feature is None:
        return tree
    own = tree._replace(left=pruned(tree.left, cost), right=pruned(tree.right, cost))
    return own if leaf_risk(own) + cost * leaves(own) < tree.risk + cost - 1e-9 else Node(tree.counts)


def costs(tree: Node) -> list[float]:
    """Costs from 0 on at which the pruned tree changes: the weakest link goes first."""

    def weakest(t: Node) -> float:
        return math.inf if t.feature is None else min((t.risk - leaf_risk(t)) / (leaves(t) - 1), weakest(t.left), weakest(t.right))

    out, own = [0.0], pruned(tree, 0.0)
    while own.feature is not None:
        out.append(weakest(own))
        own = pruned(own, out[-1])
    return out


def tree_class(tree: Node) -> Column:
    """The class that a tree gives a row, as one expression; a missing value goes beyond the threshold."""
    if tree.feature is None:
        return F.lit(tree.counts.index(max(tree.counts)))
    return F.when(F.col(tree.feature).cast("double") <= tree.threshold, tree_class(tree.left)).otherwise(tree_class(tree.right))


def cross_validated(visits: DataFrame, features: list[str], label: str, key: str, cp: list[float], folds: int = 5, depth: int = 8) -> list[tuple[float, float]]:
    """(cp, share of rows that are wrong when held out): each fold, dealt by the key's hash, is scored by trees grown on the others.

    cp is a cost as a share of the root's risk. A fold's trees, one a cp, score its
    rows in one pass.
    """
    wrong, rows = [0] * len(cp), 0
    dealt = visits.withColumn("_fold", F.pmod(F.xxhash64(key), F.lit(folds)))
    for k in range(folds):
        tree = grown(dealt.where(F.col("_fold") != k), features, label, depth)
        misses = [F.count_if(tree_class(pruned(tree, c * tree.risk)) != F.col(label)) for c in cp]
        own = dealt.where((F.col("_fold") == k) & F.col(label).isNotNull()).agg(F.count("*"), *misses).first()
        rows += own[0]
        wrong = [a + b for a, b in zip(wrong, own[1:])]
    return [(c, w / max(rows, 1)) for c, w in zip(cp, wrong)]


def fit_pruned(visits: DataFrame, features: list[str], label: str, key: str, cp: tuple[float, ...] = (0.0025, 0.01, 0.05), depth: int = 8) -> Node:
    """The grown tree pruned at the cp that cross-validation finds least often wrong; of equals the largest."""
    scores = cross_validated(visits, features, label, key, list(cp), depth=depth)
    best = min(scores, key=lambda x: (x[1], -x[0]))[0]
    tree = grown(visits, features, label, depth)
    return pruned(tree, best * tree.risk)
