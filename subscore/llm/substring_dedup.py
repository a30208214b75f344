"""Passages that repeat across documents, found through a sharded count-min sketch."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from subscore.llm.shared import open_uri
from subscore.llm.text import WordHashes, as_bytes, slices, window_hashes
from subscore.session import scratch_path

#: Text of one chunk, and cells of one shard of the sketch: what a task holds at once.
CHUNK_BYTES = 12 << 20
SHARD_BITS = 23
#: Rows of the sketch; each has at least this many cells for a window.
ROWS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
CELLS_A_WINDOW = 4


def pack(cells: np.ndarray, more: np.ndarray) -> bytes:
    """Ascending cell numbers and one flag for each, as a short byte string."""
    steps = np.diff(cells, prepend=np.int64(0))
    kind = np.uint16 if not len(steps) or steps.max() < 1 << 16 else np.uint32
    planes = steps.astype(kind).view(np.uint8).reshape(len(steps), kind().itemsize).T
    data = np.array([len(cells), kind().itemsize], np.uint32).tobytes()
    data += np.ascontiguousarray(planes).tobytes() + np.packbits(more).tobytes()
    size = np.uint64(len(data)).tobytes()
    return size + pa.Codec("zstd", 1).compress(data, asbytes=True)


def unpack(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    size = int(np.frombuffer(packed[:8], np.uint64)[0])
    data = pa.Codec("zstd").decompress(packed[8:], size, asbytes=True)
    count, width = (int(x) for x in np.frombuffer(data[:8], np.uint32))
    end = 8 + count * width
    planes = np.frombuffer(data[8:end], np.uint8).reshape(width, count)
    steps = np.ascontiguousarray(planes.T).view(np.uint16 if width == 2 else np.uint32).ravel()
    more = np.unpackbits(np.frombuffer(data[end:], np.uint8), count=count).astype(bool)
    return np.cumsum(steps, dtype=np.int64), more


def cells_of(hashes: np.ndarray, row: int, bits: int) -> np.ndarray:
    return ((hashes * np.uint64(ROWS[row])) >> np.uint64(64 - bits)).astype(np.int64)


def read_part(folder: str, chunk: int) -> pa.Table | None:
    """What a table below ``folder`` holds for one chunk."""
    system, path = open_uri(f"{folder}/chunk={chunk}")
    found = system.get_file_info(fs.FileSelector(path, allow_not_found=True))
    names = [f.path for f in found if f.base_name.endswith(".parquet")]
    tables = [pq.ParquetFile(name, filesystem=system).read() for name in names]
    return pa.concat_tables(tables) if tables else None


def copies_in(folder: str, chunk: int) -> set[int]:
    table = read_part(folder, chunk)
    return set() if table is None else set(table.column("place").to_pylist())


class Chunks:
    """The rows of batches (id, text, chunk, place), one chunk after the other."""

    def __init__(self, batches):
        self.batches = batches

    def __iter__(self):
        """(chunk, batches of it); a chunk that comes in parts comes more than once."""
        held, chunk = [], None
        for batch in self.batches:
            numbers = batch.column(batch.schema.get_field_index("~chunk")).to_numpy()
            edges = [0, *(np.flatnonzero(numbers[1:] != numbers[:-1]) + 1), len(numbers)]
            for start, end in zip(edges, edges[1:]):
                if start == end:
                    continue
                if held and numbers[start] != chunk:
                    yield chunk, held
                    held = []
                chunk = int(numbers[start])
                held.append(batch.slice(start, end - start))
        if held:
            yield chunk, held


def remove_repeated_passages(
    docs: DataFrame, width: int = 50, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``docs`` with the words of later copies of passages removed, and counts of words.

    Words are runs of other characters than blank, tab, line feed, vertical tab, form feed and
    carriage return. A window is ``width`` consecutive words of one document; each word in a
    window whose words also start in a document with a smaller id is removed. Windows are
    judged on the input. ``text`` becomes the kept words, joined by one blank; ``n_words`` and
    ``n_removed`` count words.

    1. The documents are written in chunks, and those whose whole text stands in a document
       with a smaller id are known by their digest: all their windows do, too.
    2. Each chunk's sketch of its other documents' windows, two rows of cells, is dealt out by
       ranges of cells. A range adds up what all chunks send and answers each with its cells
       that were counted twice or more. The number of cells follows the number of windows, and
       nothing is broadcast or held whole.
    3. Windows that both rows estimate repeated (none that repeats is lost) are grouped exactly,
       by 128-bit hashes, to find the smallest id; groups are reduced before they are joined.
    4. Each chunk drops the words of its windows.

    A null text has no words and stays null; an empty one stays empty. Rows without id, or
    with the same id, do not count as earlier for one another. Repeated rows come out as often
    as they came in; an empty table gives an empty table. All columns of ``docs`` stay, except
    that ``n_words`` and ``n_removed`` replace columns of these names.
    """
    spark = docs.sparkSession
    folder = scratch_path(spark, "passages")
    source = docs.select(
        *(f"`{name}`" for name in docs.columns if name.lower() not in ("n_words", "n_removed"))
    )
    total, rows = source.agg(F.sum(F.octet_length(F.col(f"`{text}`").cast("string"))), F.count("*")).first()
    total = total or 0
    each = max(1, int(CHUNK_BYTES / max(1, total / max(1, rows))))
    source.write.option("maxRecordsPerFile", each).option("compression", "zstd").parquet(f"{folder}/chunks")
    chunked = spark.read.schema(source.schema).parquet(f"{folder}/chunks")
    file = chunked.metadataColumn("_metadata")
    chunked = chunked.withColumns({"~chunk": F.xxhash64(file["file_path"]), "~place": file["row_index"]})
    words = chunked.select(
        F.col(f"`{doc_id}`").cast("long").alias("id"),
        F.col(f"`{text}`").cast("string").alias("text"),
        "~chunk",
        "~place",
    ).where("id IS NOT NULL AND text IS NOT NULL")

    # Whole copies.
    digests = words.select("id", F.unhex(F.md5("text")).alias("digest"), F.col("~chunk").alias("chunk"), F.col("~place").alias("place"))
    least = digests.groupBy("digest").agg(F.min("id").alias("first"), F.max("id").alias("last"))
    # Both sides of this join, and of that further down, are read from tables and shuffled for
    # it, so that AQE can divide the rows of a text or window that very many documents share.
    least.where("first < last").select("digest", "first").write.parquet(f"{folder}/least")
    (
        digests.join(spark.read.parquet(f"{folder}/least"), "digest")
        .where("id > first")
        .select("chunk", "place")
        .repartition("chunk")
        .write.partitionBy("chunk")
        .parquet(f"{folder}/copies")
    )

    # Cells of windows that are estimated to repeat.
    bits = max(SHARD_BITS, math.ceil(math.log2(CELLS_A_WINDOW * max(1, total / 6))))
    copies_folder, cells_folder, hits_folder = (f"{folder}/{x}" for x in ("copies", "cells", "hits"))

    def others(chunk, batches):
        """(id, place, word hashes, words) of a chunk's documents that are long enough and no copies."""
        copies, hashes = copies_in(copies_folder, chunk), WordHashes()
        for batch in batches:
            ids, places = batch.column(0).to_numpy(), batch.column(3).to_numpy()
            for at, document in enumerate(as_bytes(batch.column(1))):
                found = document.split()
                if len(found) >= width and places[at] not in copies:
                    yield int(ids[at]), int(places[at]), hashes.of(found)

    def sketch(batches):
        for chunk, parts in Chunks(batches):
            seen = [window_hashes(h, width, 1) for _, _, h in others(chunk, parts)]
            if not seen:
                continue
            seen = np.concatenate(seen)
            shards, packed = [], []
            for row in range(len(ROWS)):
                cells, counts = np.unique(cells_of(seen, row, bits), return_counts=True)
                # Only the shards that have a cell here, never more than there are windows.
                numbers, edges = np.unique(cells >> SHARD_BITS, return_index=True)
                for number, start, end in zip(numbers.tolist(), edges, [*edges[1:], len(cells)]):
                    shards.append(number * len(ROWS) + row)
                    packed.append(pack(cells[start:end] - (number << SHARD_BITS), counts[start:end] > 1))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(shards, pa.int32()),
                    pa.array(np.full(len(shards), chunk)),
                    pa.array(packed, pa.binary()),
                ],
                names=["shard", "chunk", "cells"],
            )

    def add_up(table: pa.Table) -> pa.Table:
        """Of what each chunk sent to this shard, the cells that were counted twice or more."""
        counts = np.zeros(1 << SHARD_BITS, np.uint8)
        sent = table.column("cells")
        for packed in sent:
            cells, more = unpack(packed.as_py())
            counts[cells] = np.minimum(counts[cells] + 1 + more, 2)
        chunks, repeated = [], []
        for chunk, packed in zip(table.column("chunk").to_pylist(), sent):
            cells, _ = unpack(packed.as_py())
            cells = cells[counts[cells] > 1]
            if len(cells):
                chunks.append(chunk)
                repeated.append(pack(cells, np.zeros(len(cells), bool)))
        shard = table.column("shard")[0].as_py() if table.num_rows else 0
        return pa.table(
            {
                "chunk": pa.array(chunks, pa.int64()),
                "shard": pa.array([shard] * len(chunks), pa.int32()),
                "cells": pa.array(repeated, pa.binary()),
            }
        )

    (
        words.mapInArrow(sketch, "shard int, chunk long, cells binary")
        .groupBy("shard")
        .applyInArrow(add_up, "chunk long, shard int, cells binary")
        .repartition("chunk")
        .write.partitionBy("chunk")
        .parquet(cells_folder)
    )

    def candidates(batches):
        for chunk, parts in Chunks(batches):
            table = read_part(cells_folder, chunk)
            if table is None:
                continue
            answers = sorted(zip(table.column("shard").to_pylist(), table.column("cells").to_pylist()))
            repeated = []
            for row in range(len(ROWS)):
                own = [
                    unpack(packed)[0] + (shard // len(ROWS) << SHARD_BITS)
                    for shard, packed in answers
                    if shard % len(ROWS) == row
                ]
                # A chunk read in parts was answered in parts.
                repeated.append(np.unique(np.concatenate(own)) if own else np.empty(0, np.int64))
            columns: list[list[np.ndarray]] = [[], [], [], [], []]
            for number, place, hashes in others(chunk, parts):
                seen = window_hashes(hashes, width, 1)
                maybe = np.arange(len(seen))
                for row, cells in enumerate(repeated):
                    own = cells_of(seen[maybe], row, bits)
                    at = np.minimum(np.searchsorted(cells, own), max(0, len(cells) - 1))
                    maybe = maybe[cells[at] == own] if len(cells) else maybe[:0]
                if len(maybe):
                    second = window_hashes(hashes, width, 2)
                    columns[0].append(seen[maybe].view(np.int64))
                    columns[1].append(second[maybe].view(np.int64))
                    columns[2].append(np.full(len(maybe), number))
                    columns[3].append(np.full(len(maybe), place, np.int32))
                    columns[4].append(maybe.astype(np.int32))
            if columns[0]:
                arrays = [pa.array(np.concatenate(column)) for column in columns]
                arrays.append(pa.array(np.full(len(arrays[0]), chunk)))
                whole = pa.RecordBatch.from_arrays(
                    arrays, names=["one", "two", "id", "place", "start", "chunk"]
                )
                for start in range(0, whole.num_rows, 100_000):
                    yield whole.slice(start, 100_000)

    estimated = words.mapInArrow(
        candidates, "one long, two long, id long, place int, start int, chunk long"
    )
    estimated.write.option("compression", "zstd").parquet(f"{folder}/estimated")
    estimated = spark.read.parquet(f"{folder}/estimated")
    earliest = (
        estimated.groupBy("one", "two")
        .agg(F.min("id").alias("first"), F.max("id").alias("last"))
        .where("first < last")
        .select("one", "two", "first")
    )
    earliest.write.parquet(f"{folder}/earliest")
    earliest = spark.read.parquet(f"{folder}/earliest")
    (
        estimated.join(earliest, ["one", "two"])
        .where("id > first")
        .select("chunk", "place", "start")
        .repartition("chunk")
        .write.partitionBy("chunk")
        .parquet(hits_folder)
    )

    names = source.columns
    at_text = names.index(text)
    schema = StructType(
        [
            *(StructField(f.name, StringType()) if f.name == text else f for f in source.schema.fields),
            StructField("n_words", LongType()),
            StructField("n_removed", LongType()),
        ]
    )

    def cut(batches):
        for chunk, parts in Chunks(batches):
            copies, hits = copies_in(copies_folder, chunk), read_part(hits_folder, chunk)
            places = hits.column("place").to_numpy() if hits is not None else np.empty(0, np.int32)
            order = np.argsort(places, kind="stable")
            places = places[order]
            starts = hits.column("start").to_numpy()[order] if hits is not None else places
            for part in (piece for batch in parts for piece in slices(batch, at_text)):
                texts, counts, removed = [], [], []
                rows = part.column(part.schema.get_field_index("~place")).to_numpy()
                for row, document in zip(rows, as_bytes(part.column(at_text))):
                    found = document.split() if document else []
                    counts.append(len(found))
                    low, high = np.searchsorted(places, [row, row + 1])
                    if row in copies and len(found) >= width:
                        kept = []
                    elif low < high:
                        edges = np.zeros(len(found) + 1, np.int64)
                        np.add.at(edges, starts[low:high], 1)
                        np.add.at(edges, starts[low:high] + width, -1)
                        kept = [w for w, inside in zip(found, np.cumsum(edges)) if not inside]
                    else:
                        kept = found
                    removed.append(len(found) - len(kept))
                    texts.append(None if document is None else b" ".join(kept))
                columns = list(part.columns[: len(names)])
                columns[at_text] = pa.array(texts, pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(counts, pa.int64()), pa.array(removed, pa.int64())],
                    names=schema.names,
                )

    typed = chunked.withColumn(text, F.col(f"`{text}`").cast("string"))
    typed = typed.select(*(f"`{n}`" for n in names), "~chunk", "~place")
    # Named by place, as mapInArrow looks its columns up without quoting their names.
    return typed.toDF(*(f"~{at}" for at in range(len(names))), "~chunk", "~place").mapInArrow(cut, schema)
