"""Scoring of tables and event batches."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from subscore.functions import quoted
from subscore.plans.prepare import TableSpec, prepare
from subscore.sources.messages import decode_messages, parse_messages
from subscore.sources.tables import write_scores

Scorer = Callable[[DataFrame], DataFrame]


def score(raw: DataFrame, model: PipelineModel | Scorer, spec: TableSpec) -> DataFrame:
    """(key, prediction) for every row that survives preparation.

    ``model`` is a fitted pipeline, or a function that adds a ``prediction``
    column. The key travels with its row, so dropped rows shift nothing.
    """
    transform = model if callable(model) else model.transform
    return transform(prepare(raw, spec)).select(quoted(spec.key), "prediction")


def score_events(
    events: DataFrame,
    columns: Iterable[str],
    model: PipelineModel | Scorer,
    spec: TableSpec,
    path: str | None = None,
    payload: str = "data",
) -> DataFrame:
    """Score a batch of base64 messages, and write the scores if ``path`` is given.

    An empty batch writes nothing.
    """
    # Kept, so that the look whether it is empty does not read the batch a second time.
    events = events.persist() if path is not None else events
    raw = parse_messages(decode_messages(events, payload), columns, payload)
    scores = score(raw, model, spec)
    if path is not None:
        if not events.isEmpty():
            write_scores(scores, path)
        events.unpersist()
    return scores
