"""Scoring of message streams. The plan is stateless: no shuffle, no state store."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from subscore.plans.prepare import TableSpec
from subscore.plans.score import Scorer, score
from subscore.sources.messages import parse_messages
from subscore.sources.model_store import load_version, newest_version
from subscore.sources.tables import write_scores


def _start(writer: DataStreamWriter, checkpoint: str, once: bool, every: str | None) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    if once:
        writer = writer.trigger(availableNow=True)
    elif every is not None:
        writer = writer.trigger(processingTime=every)
    return writer.start()


def _holds_messages(batch: DataFrame) -> bool:
    """Reads parts of the batch until there is a message, as a rule one; ``isEmpty`` reads of them all."""
    return bool(batch.head(1))


def start_scoring(
    messages: DataFrame,
    columns: Iterable[str],
    model: PipelineModel | Scorer,
    spec: TableSpec,
    path: str,
    checkpoint: str,
    once: bool = False,
    every: str | None = None,
    payload: str = "data",
) -> StreamingQuery:
    """Score a message stream into JSON files; the caller waits for the query.

    The file sink's log makes each message's score appear once, also after a
    restart on the same checkpoint. ``once`` works off what is there and stops.
    """
    scores = score(parse_messages(messages, columns, payload), model, spec)
    writer = scores.writeStream.format("json").outputMode("append").option("path", path)
    return _start(writer, checkpoint, once, every)


def start_batch_scoring(
    messages: DataFrame,
    columns: Iterable[str],
    model: PipelineModel | Scorer,
    spec: TableSpec,
    path: str,
    checkpoint: str,
    once: bool = False,
    every: str | None = None,
    payload: str = "data",
) -> StreamingQuery:
    """Like :func:`start_scoring`, with one folder ``batch_id=N`` per micro-batch.

    A replayed batch overwrites its own folder; an empty one writes nothing.
    """
    columns = list(columns)

    def write(batch: DataFrame, batch_id: int) -> None:
        if _holds_messages(batch):
            scores = score(parse_messages(batch, columns, payload), model, spec)
            write_scores(scores, f"{path}/batch_id={batch_id}", mode="overwrite")

    return _start(messages.writeStream.foreachBatch(write), checkpoint, once, every)


def start_versioned_scoring(
    messages: DataFrame,
    columns: Iterable[str],
    store: str,
    spec: TableSpec,
    path: str,
    checkpoint: str,
    once: bool = False,
    every: str | None = None,
    payload: str = "data",
) -> StreamingQuery:
    """Like :func:`start_batch_scoring`, with the newest model of a store and its number.

    At the beginning of each micro-batch the store is asked for its newest committed version,
    which then scores the whole batch: (key, prediction, model_version). A batch that is
    replayed after a failure may find a newer version than before; its folder is overwritten as
    a whole, so no batch is ever scored by two. A store without a committed version fails.
    """
    columns = list(columns)
    held: dict[int, PipelineModel] = {}

    def write(batch: DataFrame, batch_id: int) -> None:
        if not _holds_messages(batch):
            return
        spark = batch.sparkSession
        version = newest_version(spark, store)
        if version not in held:
            model = load_version(spark, store, version)
            held.clear()
            held[version] = model
        scores = score(parse_messages(batch, columns, payload), held[version], spec)
        scores = scores.withColumn("model_version", F.lit(version).cast("long"))
        write_scores(scores, f"{path}/batch_id={batch_id}", mode="overwrite")

    return _start(messages.writeStream.foreachBatch(write), checkpoint, once, every)
