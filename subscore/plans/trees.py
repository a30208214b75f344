"""Exact Shapley attributions of tree models, from the paths to their leaves.

A leaf is reached by a mix of two rows, some features from the explained row and the others
from a background row, if each feature on its path has its value from a row that passes the
path's limits. A feature that only the explained row passes must come from there, one that
only the background row passes must not; the leaf's value then enters each attribution with
the share of orders of these features that decide it. Nothing is walked or drawn, and the
background enters through which limits its rows pass, so its size hardly matters.
"""

from __future__ import annotations

import sys
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, functions as F

from subscore.functions import quoted
from subscore.session import remove_scratch, scratch_path

# Travels to the executors by value, which need not have the library installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Numbers that a batch of rows times the paths of all leaves may take up at once.
CELLS = 2_000_000


@dataclass(frozen=True)
class Leaves:
    """The leaves of all trees; a path holds each of its features once, with limits low < x <= high.

    Shorter paths are filled up with limits that every number passes.
    """

    feature: np.ndarray  # leaves x path
    low: np.ndarray
    high: np.ndarray
    value: np.ndarray  # what the leaf adds to the score

    def passed(self, rows: np.ndarray) -> np.ndarray:
        """(rows x leaves x path): whether a row passes the limits."""
        x = rows[:, self.feature]
        return (x > self.low) & (x <= self.high)

    def score(self, rows: np.ndarray) -> np.ndarray:
        return self.passed(rows).all(2) @ self.value


@dataclass(frozen=True)
class Background:
    """Rows that scores are compared with, as numbers in the order of ``features``."""

    features: list[str]
    rows: list[list[float]]


def is_forest(model: PipelineModel) -> bool:
    return hasattr(model.stages[-1], "treeWeights") and model.stages[-1].hasParam("numTrees")


def is_boosted(model: PipelineModel) -> bool:
    return hasattr(model.stages[-1], "treeWeights") and not model.stages[-1].hasParam("numTrees")


def tree_leaves(spark, model: PipelineModel) -> Leaves:
    """The leaves of a fitted forest or of boosted trees, read from its saved table of nodes.

    What they add up to is the probability of class 1 for a forest and, as boosted trees add up
    to no probability, their margin. Features must be plain numbers in front of the trees.
    """
    trees = model.stages[-1]
    path = scratch_path(spark, "trees")
    trees.write().save(path)
    nodes: dict[int, dict[int, dict]] = {}
    # As many rows as the model has nodes, which the driver holds already.
    for row in spark.read.parquet(f"{path}/data").collect():
        nodes.setdefault(row.treeID, {})[row.nodeData.id] = row.nodeData
    remove_scratch(spark, path)
    forest = is_forest(model)
    weights = [1.0 / len(nodes)] * len(nodes) if forest else list(trees.treeWeights)
    found: list[tuple[dict[int, tuple[float, float]], float]] = []
    for number, tree in sorted(nodes.items()):
        todo = [(0, {})]
        while todo:
            at, limits = todo.pop()
            node = tree[at]
            if node.leftChild < 0:
                stats = node.impurityStats
                value = stats[1] / sum(stats) if forest else node.prediction
                found.append((limits, value * weights[number]))
                continue
            if node.split.numCategories >= 0:
                raise ValueError("splits by category have no limits to explain them by")
            feature, threshold = node.split.featureIndex, node.split.leftCategoriesOrThreshold[0]
            low, high = limits.get(feature, (-np.inf, np.inf))
            todo.append((node.leftChild, limits | {feature: (low, min(high, threshold))}))
            todo.append((node.rightChild, limits | {feature: (max(low, threshold), high)}))
    length = max((len(limits) for limits, _ in found), default=0)
    filled = [[*limits.items(), *[(0, (-np.inf, np.inf))] * (length - len(limits))] for limits, _ in found]
    shape = len(found), length
    return Leaves(
        np.array([[feature for feature, _ in path] for path in filled], np.int64).reshape(shape),
        np.array([[low for _, (low, _) in path] for path in filled], float).reshape(shape),
        np.array([[high for _, (_, high) in path] for path in filled], float).reshape(shape),
        np.array([value for _, value in found], float),
    )


def _shares(length: int) -> tuple[np.ndarray, np.ndarray]:
    """Of all orders of u features that must be in and v that must not, the share that one decides.

    [u, v]: the share in which a given one of the u comes last of them and before all of the v;
    and in which a given one of the v comes first of them and after all of the u.
    """
    last, first = np.zeros((length + 1, length + 1)), np.zeros((length + 1, length + 1))
    for u in range(length + 1):
        for v in range(length + 1 - u):
            if u:
                last[u, v] = factorial(u - 1) * factorial(v) / factorial(u + v)
            if v:
                first[u, v] = factorial(u) * factorial(v - 1) / factorial(u + v)
    return last, first


class _Explainer:
    """Attributions of rows, one leaf and pattern of passed limits at a time."""

    def __init__(self, leaves: Leaves, background: np.ndarray):
        self.leaves = leaves
        self.others = leaves.passed(background)
        self.length = leaves.feature.shape[1]
        self.last, self.first = _shares(self.length)
        self.known: dict[int, np.ndarray] = {}
        #: The limits of each feature, rising, and what is known of the cells between them.
        self.limits = [
            np.unique([x for ends in (leaves.low, leaves.high) for x in ends[leaves.feature == at] if np.isfinite(x)])
            for at in range(background.shape[1])
        ]
        self.cells: dict[bytes, np.ndarray] = {}

    def effect(self, leaf: int, own: np.ndarray) -> np.ndarray:
        """What a leaf adds to the attribution of each feature on its path, given what the row passes."""
        other = self.others[:, leaf]
        must, must_not = own & ~other, ~own & other
        possible = (own | other).all(1)
        u, v = must.sum(1), must_not.sum(1)
        share = np.where(must, self.last[u, v][:, None], np.where(must_not, -self.first[u, v][:, None], 0.0))
        return self.leaves.value[leaf] * share[possible].sum(0) / len(other)

    def explain(self, rows: np.ndarray) -> np.ndarray:
        """(rows x features). Rows between the same limits of all trees pass the same, so one of them is explained."""
        if not len(rows):
            return np.zeros(rows.shape)
        cells = np.empty(rows.shape, np.int32)
        for at, limits in enumerate(self.limits):
            cells[:, at] = np.searchsorted(limits, rows[:, at])
        packed = cells.view(np.dtype((np.void, cells.itemsize * cells.shape[1]))).ravel()
        different, first, place = np.unique(packed, return_index=True, return_inverse=True)
        names = [cell.tobytes() for cell in different]
        new = [at for at, name in enumerate(names) if name not in self.cells]
        if len(self.cells) + len(new) > 100_000:
            self.cells.clear()
            new = range(len(names))
        for at, found in zip(new, self._explain(rows[first[list(new)]]), strict=True):
            self.cells[names[at]] = found
        return np.array([self.cells[name] for name in names]).reshape(-1, rows.shape[1])[place.ravel()]

    def _explain(self, rows: np.ndarray) -> np.ndarray:
        n_leaves = len(self.leaves.value)
        found = np.zeros(rows.shape)
        step = max(1, CELLS // max(1, n_leaves * max(1, self.length)))
        for start in range(0, len(rows), step):
            passed = self.leaves.passed(rows[start : start + step])
            packed = (passed << np.arange(self.length)).sum(2) if self.length else np.zeros(passed.shape[:2], int)
            code = (np.arange(n_leaves) << self.length) + packed
            patterns, place = np.unique(code, return_inverse=True)
            effects = np.empty((len(patterns), self.length))
            for at, pattern in enumerate(patterns.tolist()):
                if pattern not in self.known:
                    if len(self.known) >= 100_000:
                        self.known.clear()
                    own = (pattern >> np.arange(self.length)) & 1 == 1
                    self.known[pattern] = self.effect(pattern >> self.length, own)
                effects[at] = self.known[pattern]
            place = place.reshape(code.shape)
            cells = np.arange(len(passed))[:, None] * rows.shape[1]
            for k in range(self.length):
                where = (cells + self.leaves.feature[:, k]).ravel()
                added = np.bincount(where, effects[place, k].ravel(), len(passed) * rows.shape[1])
                found[start : start + step] += added.reshape(len(passed), -1)
        return found


def tree_attributions(
    rows: DataFrame,
    background: Background,
    key: Sequence[str],
    models: PipelineModel | Mapping[str, PipelineModel],
) -> DataFrame:
    """(model,) key..., feature, value, attribution: exact, for forests and boosted trees.

    Attributions explain the probability of class 1 of a forest and the margin of boosted trees
    (``explained_scorer``); those of a row add up to its score less the background's mean score. One
    narrow pass over the rows, without a shuffle; a key that comes twice comes out twice. A NULL
    feature counts as NaN, which like in the trees' own scoring is above every threshold.
    """
    if not background.rows:
        raise ValueError("the background has no rows")
    named = models if isinstance(models, Mapping) else {"": models}
    spark, features = rows.sparkSession, background.features
    base = np.array(background.rows, float)
    leaves = {}
    for name, model in named.items():
        inputs = model.stages[0].getInputCols()
        found = tree_leaves(spark, model)
        # By place among the background's features.
        order = np.array([features.index(column) for column in inputs])
        leaves[name] = Leaves(order[found.feature] if len(order) else found.feature, found.low, found.high, found.value)
    keys = [f"_key{i}" for i in range(len(key))]
    numbers = F.transform(F.array(*[F.col(quoted(x)).cast("double") for x in features]), lambda x: F.coalesce(x, F.lit(float("nan"))))
    source = rows.select(*[F.col(quoted(name)).alias(made) for name, made in zip(key, keys, strict=True)], numbers.alias("_own"))
    made = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in source.schema.fields)
    names = list(named)

    def run(batches):
        explainers = [_Explainer(leaves[name], _above(base)) for name in names]
        for batch in batches:
            own = batch.column(len(keys)).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(features))
            effects = [explainer.explain(_above(own)) for explainer in explainers]
            lists = [
                pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, len(features)), pa.int32()), pa.array(x.ravel()))
                for x in effects
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, *lists], names=[*batch.schema.names, *(f"_m{i}" for i in range(len(names)))])

    explained = source.mapInArrow(run, made + "".join(f", _m{i} array<double>" for i in range(len(names))))
    each = F.array(
        *[
            F.struct(
                F.lit(name).alias("model"), F.lit(feature).alias("feature"), F.get("_own", F.lit(at)).alias("value"),
                F.get(f"_m{i}", F.lit(at)).alias("attribution"),
            )
            for i, name in enumerate(names)
            for at, feature in enumerate(features)
        ]
    )
    back = [F.col(made).alias(name) for made, name in zip(keys, key, strict=True)]
    found = explained.select(*back, F.inline(each))
    kept = [*map(quoted, key), "feature", "value", "attribution"]
    return found.select("model", *kept) if isinstance(models, Mapping) else found.select(*kept)


def _above(rows: np.ndarray) -> np.ndarray:
    """NaN fails every comparison with a threshold, so it goes right, as a number above all would."""
    return np.where(np.isnan(rows), np.inf, np.maximum(rows, np.finfo(float).min))
