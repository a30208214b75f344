"""Subscriber records that arrive as messages."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from subscore.functions import decode_base64, parse_json_rows, quoted
from subscore.sources.message_log import register_message_log
from subscore.sources.tables import text_schema


def message_stream(
    spark: SparkSession,
    source: str,
    options: Mapping[str, str],
    schema: str | None = None,
    path: str | None = None,
) -> DataFrame:
    """Stream of messages from any connector on the class path, or from a ``message_log``.

    Start position, endpoint and credentials are the connector's own options.
    """
    if source == "message_log":
        register_message_log(spark)
    reader = spark.readStream.format(source).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path is not None else reader.load()


def parse_messages(df: DataFrame, columns: Iterable[str], payload: str = "data") -> DataFrame:
    """One text column per field of the JSON object in ``payload`` (text or binary).

    An array of objects gives a row for each. A missing field is NULL; a message that is
    not JSON gives a row of NULLs, so that it can be reported instead of vanishing.
    """
    parsed = parse_json_rows(F.col(quoted(payload)), text_schema(columns))
    # As a generator, the parse runs once per message. As a plain column it would be
    # copied into every later filter that the optimizer moves below it.
    return df.select(F.inline_outer(parsed))


def decode_messages(df: DataFrame, payload: str = "data") -> DataFrame:
    """Base64 text in ``payload`` replaced by the text it stands for."""
    return df.withColumn(payload, decode_base64(F.col(quoted(payload))))


def event_records(spark: SparkSession, path: str) -> DataFrame:
    """(data): the base64 payloads of event files, one ``{"Records": [...]}`` object each."""
    schema = "Records array<struct<kinesis struct<data: string>>>"
    events = spark.read.schema(schema).option("multiLine", True).json(path)
    return events.select(F.explode("Records.kinesis.data").alias("data"))
