"""A log of numbered messages in files, and a streaming source that reads it from any number on.

A log is a folder of segments, files of JSON lines whose names tell the number of their first
message and how many they hold. A listing is therefore all it takes to know what there is: no
file is opened to plan a batch. Segments are written whole, appear in the order of their numbers
and never change, so that a stream that lists the folder meanwhile never finds a gap.
"""

from __future__ import annotations

import math
import re
import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from subscore.operators.ranks import running_sums

# Travels to the executors by value, which need not have the library installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SEGMENT = 10_000
#: A task reads one segment where there are few, up to so many where there are more than ``PARTS``.
MOST, PARTS = 16, 32
_NAME = re.compile(r"(\d{20})-(\d{10})\.jsonl$")


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI such as ``file:/shared/x`` or ``hdfs://host/x``."""
    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:") :]
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)


@dataclass(frozen=True)
class Segment:
    """The messages numbered ``first`` up to ``last`` of a file whose own begin at ``base``."""

    path: str
    base: int
    first: int
    last: int


@dataclass(frozen=True)
class Run(InputPartition):
    """Segments that one task reads, one after the other."""

    segments: tuple[Segment, ...]


def segments(uri: str) -> list[Segment]:
    """The segments of a log, in the order of their numbers."""
    system, path = _open(uri)
    found = []
    for info in system.get_file_info(fs.FileSelector(path, allow_not_found=True)):
        if name := _NAME.search(info.base_name):
            base, count = int(name[1]), int(name[2])
            found.append(Segment(info.path, base, base, base + count))
    return sorted(found, key=lambda segment: segment.base)


def end_of(uri: str) -> int:
    """The number that the next message of a log gets."""
    return max((segment.last for segment in segments(uri)), default=0)


def append_messages(
    messages: DataFrame, uri: str, order: Sequence[str], value: str = "value", segment: int = SEGMENT
) -> int:
    """Add the messages in column ``value`` to a log, in the order of ``order``; the log's new end.

    Numbers go on from the log's end, without gaps. They are counted over ranges of ``order``,
    which must be distinct, and each segment is written by one task, as a file that no reader
    looks at: a task that runs again replaces its own segment by the same. Once all are there, they
    get their names one after the other, so a stream on the log reads up to the last one named, and
    an append that fails adds nothing. One writer at a time. NULL messages are written as empty
    ones; line breaks within a message are not allowed.
    """
    start = end_of(uri)

    def named(folder: str, first: int, count: int) -> str:
        return f"{folder}/{start + first:020d}-{count:010d}.jsonl"

    keyed = messages.select(F.struct(*order).alias("_order"), F.col(value).cast("string").alias("value"), F.lit(1).alias("n"))
    numbered = running_sums(keyed, [], "_order", ["n"]).select(
        F.col("before_n").alias("offset"), F.floor(F.col("before_n") / segment).alias("segment"), "value"
    )
    dealt = numbered.repartition("segment").sortWithinPartitions("offset")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, folder = _open(uri)
        system.create_dir(folder, recursive=True)
        held: list[pa.RecordBatch] = []

        def flush() -> pa.RecordBatch:
            table = pa.Table.from_batches(held)
            if pc.any(pc.match_substring(table.column("value"), "\n")).as_py():
                raise ValueError("a message holds a line break")
            name = named(folder, table.column("offset")[0].as_py(), len(table))
            with system.open_output_stream(name + ".part", compression=None) as out:
                for texts in table.column("value").chunks:
                    out.write(_lines(texts))
            held.clear()
            return pa.RecordBatch.from_pylist([{"count": len(table)}])

        for batch in batches:
            numbers = batch.column(1).to_numpy(zero_copy_only=False)
            ends = [*(np.flatnonzero(np.diff(numbers)) + 1).tolist(), len(numbers)] if len(numbers) else []
            for begin, end in zip([0, *ends], ends):
                if held and held[-1].column(1)[0].as_py() != numbers[begin]:
                    yield flush()
                held.append(batch.slice(begin, end - begin))
        if held:
            yield flush()

    written = dealt.mapInArrow(write, "count long").agg(F.sum("count")).first()[0] or 0
    system, folder = _open(uri)
    for first in range(0, written, segment):
        name = named(folder, first, min(segment, written - first))
        system.move(name + ".part", name)
    return start + written


def _lines(texts: pa.Array) -> bytes:
    """The texts as lines, a missing one as an empty one."""
    # In 64-bit offsets, so that one part of a segment may be of any size.
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    lines = pc.binary_join_element_wise(texts, pa.scalar("", pa.large_string()), pa.scalar("\n", pa.large_string()))
    if not len(lines):
        return b""
    ends = np.frombuffer(lines.buffers()[1], np.int64)[lines.offset : lines.offset + len(lines) + 1]
    return lines.buffers()[2].slice(int(ends[0]), int(ends[-1] - ends[0])).to_pybytes()


class _Log:
    """Where a log is read from, as its options say."""

    def __init__(self, options: dict[str, str]):
        self.uri = options.get("path") or ""
        if not self.uri:
            raise ValueError("a message log needs a path")
        self.start = options.get("startingoffset", "earliest")
        if self.start not in ("earliest", "latest") and not self.start.isdigit():
            raise ValueError(f"startingOffset is earliest, latest or a number, not {self.start}")
        self.strict = options.get("failondataloss", "true").lower() != "false"

    def first(self) -> int:
        found = segments(self.uri)
        if self.start == "earliest":
            return found[0].base if found else 0
        return found[-1].last if self.start == "latest" and found else 0 if self.start == "latest" else int(self.start)

    def between(self, start: int, end: int) -> list[Run]:
        """The segments that hold messages from ``start`` up to ``end``, dealt to tasks in their order."""
        parts, reached = [], start
        for found in segments(self.uri):
            if found.last <= start or found.base >= end:
                continue
            if found.base > reached and self.strict:
                raise ValueError(f"messages {reached} to {found.base - 1} are no longer in the log")
            parts.append(Segment(found.path, found.base, max(start, found.base), min(end, found.last)))
            reached = found.last
        if reached < end and self.strict:
            raise ValueError(f"messages {reached} to {end - 1} are no longer in the log")
        size = max(1, min(MOST, math.ceil(len(parts) / PARTS)))
        return [Run(tuple(parts[at : at + size])) for at in range(0, len(parts), size)]

    def rows(self, run: Run) -> Iterator[pa.RecordBatch]:
        system, _ = _open(self.uri)
        for part in run.segments:
            yield from self._segment(system, part)

    def _segment(self, system: fs.FileSystem, part: Segment) -> Iterator[pa.RecordBatch]:
        with system.open_input_stream(part.path, compression=None) as stream:
            lines = stream.read().decode().split("\n")[part.first - part.base : part.last - part.base]
        for at in range(0, len(lines), 5000):
            some = lines[at : at + 5000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(part.first + at, part.first + at + len(some)), pa.int64()), pa.array(some, pa.string())],
                names=["offset", "value"],
            )


class _StreamReader(DataSourceStreamReader):
    def __init__(self, log: _Log):
        self.log = log

    def initialOffset(self) -> dict:
        return {"offset": self.log.first()}

    def latestOffset(self) -> dict:
        # A start beyond the end waits for its message.
        end = end_of(self.log.uri)
        return {"offset": max(end, int(self.log.start)) if self.log.start.isdigit() else end}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        return self.log.between(start["offset"], end["offset"])

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        return self.log.rows(partition)

    def commit(self, end: dict) -> None:
        """Nothing is removed from a log by reading it."""


class _Reader(DataSourceReader):
    def __init__(self, log: _Log):
        self.log = log

    def partitions(self) -> Sequence[InputPartition]:
        return self.log.between(self.log.first(), end_of(self.log.uri))

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        return self.log.rows(partition)


class MessageLog(DataSource):
    """``format("message_log")``: (offset, value) of a log's messages, as a table or a stream.

    Options: ``path``; ``startingOffset``: ``earliest`` (default), ``latest`` or the number of the
    first message to be read, used when a stream has no checkpoint yet; ``failOnDataLoss``:
    ``false`` passes over messages that are no longer there instead of failing. Each batch reads
    the numbers from its start to its end; a task reads one segment in between, or several where
    there are very many.
    """

    @classmethod
    def name(cls) -> str:
        return "message_log"

    def schema(self) -> str:
        return "offset long, value string"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(_Log(self.options))

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _StreamReader(_Log(self.options))


def register_message_log(spark: SparkSession) -> None:
    spark.dataSource.register(MessageLog)
