"""Classifier pipelines."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import Any

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, functions as F

from subscore.functions import quoted

FAMILIES = {
    "rf": RandomForestClassifier,
    "log_reg": LogisticRegression,
    "gbdt": GBTClassifier,
    "svm": LinearSVC,
}

# Families whose fit depends on the scale of the features.
SCALED = frozenset({"log_reg", "svm"})

#: How often each row of a folded table counts.
TIMES = "_times"
#: Rows are folded where there are at least so many of them to each different one.
FOLDED = 4
#: A folded table has a part for so many rows: a learner starts a task for each part hundreds of times.
PART = 10_000


def classifier(family: str, **params: Any):
    if family not in FAMILIES:
        raise ValueError(f"unknown family {family!r}, choose from {sorted(FAMILIES)}")
    return FAMILIES[family](**params)


def build_pipeline(
    family: str, features: Sequence[str], label: str, scale: bool | None = None, **params: Any
) -> Pipeline:
    """Assemble, standardise where the family needs it (or as told), classify."""
    estimator = classifier(family, **params).setLabelCol(label).setFeaturesCol("features")
    stages = [VectorAssembler(inputCols=list(features), outputCol="features")]
    if family in SCALED if scale is None else scale:
        stages.append(StandardScaler(inputCol="features", outputCol="features_scaled"))
        estimator = estimator.setFeaturesCol("features_scaled")
    return Pipeline(stages=[*stages, estimator])


def counts_rows(pipeline: Pipeline) -> bool:
    """Whether fitting one row with a weight of n equals fitting it n times.

    So it is for regressions and SVMs of features that the pipeline scales, and for boosted trees that
    use all rows in each round. Forests draw the rows of each tree one by one.
    """
    *before, learner = pipeline.getStages()
    if learner.isDefined("weightCol"):
        return False
    if isinstance(learner, GBTClassifier):
        whole = learner.getSubsamplingRate() == 1.0 and learner.getMinInstancesPerNode() == 1
        return whole and not learner.isDefined("validationIndicatorCol")
    scaled = any(isinstance(stage, StandardScaler) for stage in before)
    return scaled and isinstance(learner, (LogisticRegression, LinearSVC))


def fold(rows: DataFrame, columns: Sequence[str]) -> DataFrame | None:
    """The different rows of the columns, and in ``TIMES`` how often there is each; None if few are equal.

    A narrow pass estimates how many there are, so that rows which are nearly all different are
    not shuffled in vain.
    """
    named = [F.col(quoted(name)) for name in dict.fromkeys(columns)]
    total, different = rows.agg(F.count("*"), F.approx_count_distinct(F.xxhash64(*named))).first()
    if different * FOLDED > total:
        return None
    return rows.groupBy(*named).agg(F.count("*").alias(TIMES)).coalesce(max(1, math.ceil(different / PART)))


def fit(pipeline: Pipeline, rows: DataFrame, params: Mapping | None = None) -> PipelineModel:
    """The fitted pipeline; a folded table's rows count as often as it says (see :func:`counts_rows`)."""
    if TIMES not in rows.columns:
        return pipeline.fit(rows, dict(params or {}))
    before = fit_features(pipeline, rows)
    learner = pipeline.getStages()[-1].copy(dict(params or {})).setWeightCol(TIMES)
    if learner.hasParam("standardization"):
        # The features have a deviation of one already. The learner would work one out from its
        # weights as if they were no counts, and penalise by that.
        learner = learner.setStandardization(False)
    return PipelineModel([*before.stages, learner.fit(before.transform(rows))])


def fit_features(pipeline: Pipeline, rows: DataFrame) -> PipelineModel:
    """What a pipeline has in front of its learner, fitted; a folded table's rows count as in :func:`fit`."""
    *before, _ = pipeline.getStages()
    if TIMES not in rows.columns or not before:
        return Pipeline(stages=before).fit(rows)
    assembler, *scalers = before
    return PipelineModel([assembler, *[_fit_scaler(scaler, rows, assembler.getInputCols()) for scaler in scalers]])


def _fit_scaler(scaler: StandardScaler, rows: DataFrame, features: Sequence[str]):
    """The scaler fitted to what a folded table stands for, by two rows of the same means and deviations.

    A scaler knows no weights, so it cannot be fitted to the folded rows themselves.
    """
    times, numbers = F.col(TIMES), [F.col(quoted(name)).cast("double") for name in features]
    total, *sums = rows.agg(F.sum(times), *[F.sum(times * x) for x in numbers]).first()
    means = [x / total if x is not None else math.nan for x in sums]
    squares = rows.agg(*[F.sum(times * (x - mean) * (x - mean)) for x, mean in zip(numbers, means, strict=True)]).first()
    half = [math.sqrt((x if x is not None else math.nan) / max(1, total - 1) / 2) for x in squares]
    pair = [(Vectors.dense([mean + sign * h for mean, h in zip(means, half, strict=True)]),) for sign in (-1, 1)]
    return scaler.fit(rows.sparkSession.createDataFrame(pair, [scaler.getInputCol()]))


def fit_models(
    rows: DataFrame,
    settings: Mapping[str, tuple[str, Mapping[str, Any]]],
    features: Sequence[str],
    label: str,
) -> dict[str, PipelineModel]:
    """Models by name, from (family, params) by name, fitted side by side.

    A fit is a long row of short jobs; several of them keep the executors busy. Where many rows are
    equal, all families that can count them read each different row once.
    """
    pipelines = {name: build_pipeline(family, features, label, **params) for name, (family, params) in settings.items()}
    few = fold(rows, [*features, label]) if any(map(counts_rows, pipelines.values())) else None
    if few is not None:
        few.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        with ThreadPoolExecutor(max(1, len(settings))) as pool:
            fits = {
                name: pool.submit(fit, pipeline, rows if few is None or not counts_rows(pipeline) else few)
                for name, pipeline in pipelines.items()
            }
            return {name: found.result() for name, found in fits.items()}
    finally:
        if few is not None:
            few.unpersist()
