"""Comparison of fitted models on one table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, functions as F

from subscore.functions import quoted, vector_item
from subscore.operators.metrics import area_under_roc, class_metrics, roc_areas
from subscore.plans.models import TIMES, fold


def evaluate_models(
    models: Mapping[str, PipelineModel], df: DataFrame, label: str, num_bins: int = 0
) -> DataFrame:
    """(model, metric, value): area under ROC, f1, accuracy, recall, precision of each model.

    The models score the table one after the other in a single scan. Only label,
    prediction and score are kept of that, and all metrics are taken from there: the areas
    of all models in one pass, or with ``num_bins`` thresholds one after the other. Where many
    rows are equal in all that the models look at, each different one is scored once and counted.
    """
    outcomes = [f"_outcome{i}" for i in range(len(models))]
    firsts = [model.stages[0] for model in models.values()]
    few = None
    if all(isinstance(first, VectorAssembler) for first in firsts):
        few = fold(df, [*(name for first in firsts for name in first.getInputCols()), label])
    wide = df.withColumn(TIMES, F.lit(1).cast("long")) if few is None else few
    for (name, model), outcome in zip(models.items(), outcomes, strict=True):
        found = F.struct(
            F.lit(name).alias("model"),
            F.col("prediction"),
            vector_item(F.col("rawPrediction")).alias("score"),
        )
        wide = model.transform(wide).select(*map(quoted, wide.columns), found.alias(outcome))
    scored = wide.select(
        F.col(quoted(label)).cast("double").alias("label"), TIMES, F.inline(F.array(*outcomes))
    ).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        rows = [tuple(row) for row in class_metrics(scored, "label", by=["model"], times=TIMES).collect()]
        if not num_bins:
            areas = roc_areas(scored, "label", "score", by=["model"], times=TIMES).collect()
            rows += [(row["model"], "roc_auc", row["roc_auc"]) for row in areas]
        for name in models if num_bins else ():
            part = scored.where(F.col("model") == name)
            rows.append((name, "roc_auc", area_under_roc(part, "label", "score", num_bins, TIMES)))
    finally:
        scored.unpersist()
    return df.sparkSession.createDataFrame(rows, "model string, metric string, value double")
