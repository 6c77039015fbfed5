"""Boosted regression trees: fitted by Spark ML, carried as arrays, evaluated for many rows at once.

A tree's prediction is one of its leaf values, so a sum of trees takes finitely many values, whatever goes in: a forecast that
is fed back as history cannot run away.
"""

from __future__ import annotations

import re
from typing import NamedTuple

import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

RULE = re.compile(r"If \(feature (\d+) <= ([^)]+)\)")

#: A tree as nested tuples: a number for a leaf, else (feature, threshold, tree where the feature is at most that, tree otherwise).
Tree = float | tuple


class Forest(NamedTuple):
    """The nodes of all trees: a leaf has feature -1 and is its own successor. ``roots`` and ``weights`` have one entry for each tree."""

    names: list[str]
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    weights: np.ndarray
    depth: int

    @classmethod
    def of(cls, trees: list[Tree], names: list[str], weights: list[float] | None = None) -> Forest:
        nodes: list[list] = []
        deepest = 0

        def add(tree: Tree, level: int) -> int:
            nonlocal deepest
            deepest = max(deepest, level)
            at = len(nodes)
            if not isinstance(tree, tuple):
                nodes.append([-1, 0.0, at, at, float(tree)])
                return at
            feature, threshold, low, high = tree
            nodes.append([names.index(feature) if isinstance(feature, str) else feature, float(threshold), 0, 0, 0.0])
            nodes[at][2] = add(low, level + 1)
            nodes[at][3] = add(high, level + 1)
            return at

        roots = [add(t, 0) for t in trees]
        f, t, low, high, v = zip(*nodes) if nodes else ((),) * 5
        whole = [np.array(x, np.int64) for x in (f, low, high)]
        return cls(names, whole[0], np.array(t), whole[1], whole[2], np.array(v), np.array(roots, np.int64), np.array(weights or [1.0] * len(roots)), deepest)

    @classmethod
    def exported(cls, model, names: list[str]) -> Forest:
        """The trees of a fitted Spark model of continuous features (a single tree, a random forest or boosted trees)."""
        trees = list(getattr(model, "trees", [model]))
        weights = [float(w) for w in getattr(model, "treeWeights", [1.0])]
        return cls.of([_parsed(t.toDebugString) for t in trees], names, weights)

    def predict(self, columns: dict[str, np.ndarray]) -> np.ndarray:
        """The weighted sum of all trees for each row of the named columns. A missing number goes right, as in Spark."""
        x = np.stack([np.asarray(columns[c], dtype=float) for c in self.names], axis=1)
        rows = np.arange(len(x))[:, None]
        at = np.broadcast_to(self.roots, (len(x), len(self.roots)))
        for _ in range(self.depth):
            goes_left = x[rows, self.feature[at]] <= self.threshold[at]
            at = np.where(goes_left, self.left[at], self.right[at])
        return self.value[at] @ self.weights

    def bounds(self) -> tuple[float, float]:
        """No prediction is below or above these: the sums of the smallest and the largest leaves."""
        ends = [self._leaves(r) for r in self.roots.tolist()]
        low = sum(min(w * min(v), w * max(v)) for v, w in zip(ends, self.weights.tolist()))
        return low, sum(max(w * min(v), w * max(v)) for v, w in zip(ends, self.weights.tolist()))

    def _leaves(self, root: int) -> list[float]:
        out, open_ = [], [root]
        while open_:
            k = open_.pop()
            if self.feature[k] < 0:
                out.append(float(self.value[k]))
            else:
                open_ += [int(self.left[k]), int(self.right[k])]
        return out

    def column(self) -> Column:
        """The same as a column expression, for small forests: a CASE for each tree."""
        total = F.lit(0.0)
        for root, weight in zip(self.roots.tolist(), self.weights.tolist()):
            total = total + self._case(root) * weight
        return total

    def _case(self, k: int) -> Column:
        if self.feature[k] < 0:
            return F.lit(float(self.value[k]))
        goes_left = F.col(self.names[self.feature[k]]) <= float(self.threshold[k])
        return F.when(goes_left, self._case(int(self.left[k]))).otherwise(self._case(int(self.right[k])))


def _parsed(text: str) -> Tree:
    """A tree from Spark's description of it: an indented If/Else block for each split, ``Predict:`` for each leaf."""
    lines = [x.strip() for x in text.split("\n")[1:] if x.strip()]
    at = 0

    def node() -> Tree:
        nonlocal at
        line = lines[at]
        at += 1
        if line.startswith("Predict:"):
            return float(line.split(":")[1])
        found = RULE.match(line)
        if not found:
            raise ValueError(f"not a split of a continuous feature: {line}")
        low = node()
        at += 1  # Else
        return int(found[1]), float(found[2]), low, node()

    return node()


def fit_boosted(table: DataFrame, features: list[str], target: str = "trip_count", trees: int = 20, depth: int = 5, seed: int = 1):
    """Gradient-boosted trees of squared error, fitted by Spark ML on the rows without nulls; these are written once for its passes."""
    rows = cut_lineage(table.select(*features, F.col(target).cast("double").alias(target)).dropna())
    assembled = VectorAssembler(inputCols=features, outputCol="features").transform(rows)
    return GBTRegressor(labelCol=target, featuresCol="features", maxIter=trees, maxDepth=depth, stepSize=0.3, seed=seed, cacheNodeIds=False).fit(assembled)


def score_boosted(table: DataFrame, model, features: list[str], name: str = "yhat") -> DataFrame:
    """Adds the fitted model's prediction, at least 0, on Spark's own evaluation of the trees."""
    assembled = VectorAssembler(inputCols=features, outputCol="_features", handleInvalid="keep").transform(table)
    scored = model.setFeaturesCol("_features").setPredictionCol("_prediction").transform(assembled)
    return scored.withColumn(name, F.greatest(F.lit(0.0), F.col("_prediction"))).drop("_features", "_prediction")
