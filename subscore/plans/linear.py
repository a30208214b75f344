"""Walks of models whose score is the sigmoid of a weighted sum, a batch of rows at a time.

Such a model scores a point of a walk by what each feature adds to its margin, from the explained
row or from the background row. So the points are never made: a batch goes along each walk, one
feature after the other, and only rows that the feature differs in are scored at its step.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LinearSVCModel, LogisticRegressionModel
from pyspark.ml.feature import StandardScalerModel, VectorAssembler
from pyspark.sql import DataFrame, functions as F

# Travels to the executors by value, which need not have the library installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Numbers that the features of a batch of rows may take up at once.
CELLS = 200_000


@dataclass(frozen=True)
class Linear:
    """What the features ``names`` weigh in a margin; its sigmoid is the score."""

    names: tuple[str, ...]
    weights: tuple[float, ...]
    intercept: float


def linear_model(model: PipelineModel) -> Linear | None:
    """A pipeline of an assembler, perhaps a scaler, and a regression or SVM of two classes; None for others."""
    if len(model.stages) not in (2, 3) or not isinstance(model.stages[0], VectorAssembler):
        return None
    assembler, *scalers, learner = model.stages
    if isinstance(learner, LogisticRegressionModel):
        if learner.numClasses != 2 or learner.coefficientMatrix.numRows != 1:
            return None
    elif not isinstance(learner, LinearSVCModel):
        return None
    weights, intercept = np.array(learner.coefficients.toArray(), float), float(learner.intercept)
    names, column = assembler.getInputCols(), assembler.getOutputCol()
    if assembler.getHandleInvalid() != "error" or len(names) != len(weights) or len(set(names)) != len(names):
        return None
    for scaler in scalers:
        if not isinstance(scaler, StandardScalerModel) or scaler.getInputCol() != column:
            return None
        column = scaler.getOutputCol()
        if scaler.getWithStd():
            std = np.array(scaler.std.toArray(), float)
            weights = np.divide(weights, std, out=np.zeros(len(std)), where=std != 0)
        if scaler.getWithMean():
            intercept -= float(weights @ scaler.mean.toArray())
    if learner.getFeaturesCol() != column:
        return None
    return Linear(tuple(names), tuple(weights.tolist()), intercept)


class _Walker:
    """The mean effects of each feature over all walks, for one model."""

    def __init__(self, model: Linear, features: Sequence[str], walks: Sequence[Mapping]):
        place = {name: at for at, name in enumerate(features)}
        self.inputs = [place[name] for name in model.names]
        self.weights = np.zeros(len(features))
        self.weights[self.inputs] = model.weights
        self.used = set(self.inputs)
        self.intercept = model.intercept
        self.walks = [(walk["base"], [at for at in walk["path"] if at in self.used]) for walk in walks]

    def effects(self, own: np.ndarray) -> np.ndarray:
        """(features x rows), of numbers in the same form."""
        found = np.zeros(own.shape)
        adds = {at: own[at] * self.weights[at] for at in self.inputs}
        for base, path in self.walks:
            left = {at: base[at] * self.weights[at] for at in path}
            # What the features ahead still add: sums from the end, so nothing is taken off again.
            ahead, total = [], self.intercept
            for at in reversed(path):
                ahead.append(total)
                total += left[at]
            score, reached = np.full(own.shape[1], _sigmoid(total)), np.zeros(own.shape[1])
            for at, rest in zip(path, reversed(ahead), strict=True):
                reached += adds[at]
                where = np.flatnonzero(own[at] != base[at])
                if len(where):
                    now = _sigmoid(reached[where] + rest)
                    found[at][where] += now - score[where]
                    score[where] = now
        return found / len(self.walks)


def _sigmoid(margin):
    with np.errstate(over="ignore"):
        return 1.0 / (1.0 + np.exp(-margin))


def walked(
    numbered: DataFrame, features: Sequence[str], keys: Sequence[str], walks: Sequence[Mapping], models: Mapping[str, Linear]
) -> DataFrame:
    """(keys, _own, models...): the mean effects of all features over the walks, an array for each model."""
    n = len(features)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walkers = [_Walker(model, features, walks) for model in models.values()]
        for batch in batches:
            # What is missing comes as NaN, and the assembler of a model refuses both.
            own = batch.column(len(keys)).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, n)
            lists = []
            for walker in walkers:
                if np.isnan(own[:, walker.inputs]).any():
                    raise ValueError("a feature to be explained is missing or NaN")
                found, step = np.empty(own.shape), max(1, CELLS // max(1, n))
                for start in range(0, len(own), step):
                    some = slice(start, start + step)
                    found[some] = walker.effects(np.ascontiguousarray(own[some].T)).T
                ends = pa.array(np.arange(0, found.size + 1, n), pa.int32())
                lists.append(pa.ListArray.from_arrays(ends, pa.array(found.ravel())))
            yield pa.RecordBatch.from_arrays([*batch.columns, *lists], names=[*batch.schema.names, *models])

    made = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in numbered.schema.fields)
    return numbered.mapInArrow(run, made + "".join(f", `{name}` array<double>" for name in models))


def linear_sums(
    numbered: DataFrame, features: Sequence[str], keys: Sequence[str], walks: Sequence[Mapping], models: Mapping[str, Linear]
) -> DataFrame:
    """(keys, _feature, value, _rows, models...): the effects of each row, which is sent once, to find keys that come twice."""
    places = range(len(features))
    explained = walked(numbered, features, keys, walks, models)
    wide = explained.select(
        *keys,
        *[F.get("_own", F.lit(i)).alias(f"_own{i}") for i in places],
        *[F.get(made, F.lit(i)).alias(f"{made}_{i}") for made in models for i in places],
    )
    sums = [F.sum(f"{made}_{i}").alias(f"{made}_{i}") for made in models for i in places]
    summed = wide.groupBy(*keys).agg(
        F.count("*").alias("_rows"), *[F.max(f"_own{i}").alias(f"_own{i}") for i in places], *sums
    )
    each = [
        F.struct(
            F.lit(i).alias("_feature"), F.col(f"_own{i}").alias("value"), *[F.col(f"{made}_{i}").alias(made) for made in models]
        )
        for i in places
    ]
    return summed.select(*keys, "_rows", F.inline(F.array(*each)))
