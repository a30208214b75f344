"""Words of texts, and columns appended to a table in Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType, StructField, StructType

#: Text handed to Python code at once; one longer text makes a slice of its own.
SLICE_BYTES = 4 << 20
#: Bytes of an Arrow batch on its way to or from a Python worker, unless the session says otherwise.
BATCH_BYTES = 8 << 20


def _word_table() -> bytes:
    table = bytearray(b" " * 256)
    for byte in [*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]:
        table[byte] = byte
    for byte in range(0x41, 0x5B):
        table[byte] = byte + 32
    return bytes(table)


_WORDS = _word_table()


def words_of(text: bytes | None) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of a UTF-8 text after lower-casing A-Z."""
    return text.translate(_WORDS).split() if text else []


class WordHashes(dict):
    """64-bit hash of each word, remembered for at most ``limit`` words (some 10 MB)."""

    def __init__(self, limit: int = 60_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: Sequence[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit over the output."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def window_hashes(words: np.ndarray, width: int, seed: int) -> np.ndarray:
    """64-bit hash of every ``width`` consecutive word hashes, built from halves of doubled size."""
    if len(words) < width:
        return np.empty(0, np.uint64)
    level = mixed(words + np.uint64(seed))
    factor = np.uint64(0x9E3779B97F4A7C15)
    done, offset, size = None, 0, 1
    while True:
        if width & size:
            part = level[offset : offset + len(words) - width + 1]
            done = part if done is None else mixed(done * factor + part)
            offset += size
        size *= 2
        if size > width:
            return done
        half = size // 2
        level = mixed(level[:-half] * factor + level[half:])


def as_bytes(column: pa.Array) -> list[bytes | None]:
    large = pa.types.is_large_string(column.type)
    return column.cast(pa.large_binary() if large else pa.binary()).to_pylist()


def slices(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of about ``SLICE_BYTES`` of text."""
    sizes = np.asarray(
        [0 if n is None else n for n in pa.compute.binary_length(batch.column(column)).to_pylist()],
        np.int64,
    )
    ends = np.cumsum(sizes)
    start = 0
    while start < batch.num_rows:
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + SLICE_BYTES, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def small_batches(spark: SparkSession) -> None:
    """Bound the bytes of Arrow batches, of which the JVM and each Python worker hold several."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if name not in spark.conf.getAll:
        spark.conf.set(name, str(BATCH_BYTES))


def append_columns(
    df: DataFrame,
    column: str,
    keep: Iterable[str] | None,
    added: Sequence[tuple[str, DataType]],
    prepare: Callable[[], Callable[[list[bytes | None]], Sequence[pa.Array]]],
) -> DataFrame:
    """Columns ``keep`` of ``df`` (None: all) and ``added`` ones, computed from a text column.

    ``prepare`` runs once per task and gives the function from texts to arrays.
    A kept column named like an added one is replaced by it. A text that is kept is sent once.
    """
    small_batches(df.sparkSession)
    new = {name.lower() for name, _ in added}
    kept = [name for name in (df.columns if keep is None else keep) if name.lower() not in new]
    own = [at for at, name in enumerate(kept) if name == column and df.schema[name].dataType == StringType()]
    source = df.select(
        *(F.col(f"`{name}`") for name in kept),
        *(() if own else [F.col(f"`{column}`").cast("string").alias("~text")]),
    )
    place = own[0] if own else len(kept)
    schema = StructType([*source.schema.fields[: len(kept)], *(StructField(*field) for field in added)])
    names = schema.names

    def run(batches):
        compute = prepare()
        for batch in batches:
            for part in slices(batch, place):
                arrays = compute(as_bytes(part.column(place)))
                yield pa.RecordBatch.from_arrays([*part.columns[: len(kept)], *arrays], names=names)

    # Named by place, as mapInArrow looks its columns up without quoting their names.
    return source.toDF(*(f"~{at}" for at in range(len(source.columns)))).mapInArrow(run, schema)
