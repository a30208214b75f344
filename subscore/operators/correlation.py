"""Pearson correlation of numeric columns."""

from __future__ import annotations

import math
import sys
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation
from pyspark.sql import DataFrame, functions as F

from subscore.functions import quoted
from subscore.operators.small import settle

# Travels to the executors by value, which need not have the library installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Columns of a block; a task holds a few matrices of this many by as many numbers.
BLOCK = 256
#: Rows whose products are summed at once.
STRIP = 1024
#: Pairs of blocks whose sums a task holds at once, and parts that those of a pair are merged in.
HELD, PARTS = 64, 32


def label_correlation(df: DataFrame, label: str, columns: Iterable[str]) -> DataFrame:
    """(column, correlation) of every column with ``label``, largest first.

    One aggregate for all columns; the label itself is part of the result.
    """
    names = list(dict.fromkeys([*columns, label]))
    target = F.col(quoted(label)).cast("double")
    row = df.agg(
        *[F.corr(F.col(quoted(name)).cast("double"), target).alias(name) for name in names]
    )
    long = row.unpivot([], [quoted(name) for name in names], "column", "correlation")
    return long.orderBy(F.col("correlation").desc_nulls_last(), "column")


def correlation_matrix(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """(left, right, correlation) for every pair of columns, both orders and the diagonal.

    The driver holds one number per pair of columns, whatever the number of rows.
    Rows with a missing value in any of the columns are left out.
    """
    names = list(columns)
    assembler = VectorAssembler(inputCols=names, outputCol="features", handleInvalid="skip")
    vectors = assembler.transform(df.select(*[quoted(name) for name in names]))
    matrix = Correlation.corr(vectors.select("features"), "features").first()[0].toArray()
    rows = [
        (left, right, float(matrix[i, j]))
        for i, left in enumerate(names)
        for j, right in enumerate(names)
    ]
    return df.sparkSession.createDataFrame(rows, "left string, right string, correlation double")


def wide_correlation(df: DataFrame, columns: Iterable[str], block: int = BLOCK) -> DataFrame:
    """(left, right, correlation) for every pair of columns, both orders and the diagonal.

    As :func:`correlation_matrix`, for any number of columns: the result is computed and stays
    on the executors. Rows are packed into strips, and each strip into blocks of columns; every
    pair of blocks adds up its products, centred at the strip's own means, strip by strip, and
    the sums of two strips are merged by their means, so that large means cost no digits. A
    task holds the sums of at most 64 pairs of blocks, and the driver nothing but the names.
    The sums of a pair are merged in 32 parts, then once more.

    Rows with a missing value in any of the columns are left out. A column without variance has
    no correlation (NaN); without rows there are none.
    """
    names = list(columns)
    n_blocks = math.ceil(len(names) / block)
    x = F.array(*[F.col(quoted(name)).cast("double") for name in names])
    usable = F.forall(x, lambda value: value.isNotNull() & ~F.isnan(value))

    def strips(batches):
        """Each strip's columns, block by block, as bytes; a strip is named by task and number."""
        task, number = TaskContext.get().partitionId(), 0
        for batch in batches:
            rows = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(names))
            for start in range(0, len(rows), STRIP):
                part = rows[start : start + STRIP]
                number += 1
                yield pa.RecordBatch.from_pylist(
                    [
                        {
                            "strip": (task << 32) + number,
                            "at": at,
                            "rows": np.ascontiguousarray(part[:, at * block : (at + 1) * block]).tobytes(),
                        }
                        for at in range(n_blocks)
                    ],
                    schema=pa.schema([("strip", pa.int64()), ("at", pa.int32()), ("rows", pa.binary())]),
                )

    packed = settle(
        df.where(usable).select(x.alias("x")).mapInArrow(strips, "strip long, at int, rows binary")
    )
    width = lambda at: min(block, len(names) - at * block)

    def centred(data: bytes, at: int) -> tuple[np.ndarray, np.ndarray]:
        rows = np.frombuffer(data).reshape(-1, width(at))
        mean = rows.mean(0)
        return rows - mean, mean

    def sums(batches):
        """Per pair of blocks in this task: rows, means of both, sums of products about them."""
        held: dict[tuple[int, int], list] = {}
        part = TaskContext.get().partitionId() % PARTS
        for batch in batches:
            for row in batch.to_pylist():
                (left, a), (right, b) = (centred(row[side], row[at]) for side, at in (("left", "i"), ("right", "j")))
                new = [len(left), a, b, left.T @ right, (left**2).sum(0), (right**2).sum(0)]
                key = row["i"], row["j"]
                if key not in held and len(held) == HELD:
                    yield from (_packed(*key, part, sums) for key, sums in held.items())
                    held.clear()
                held[key] = _merged(held[key], new) if key in held else new
        yield from (_packed(*key, part, sums) for key, sums in held.items())

    def merge(batches):
        """The sums of consecutive rows of one pair and part as one row."""
        now, held = None, None
        for batch in batches:
            for row in batch.to_pylist():
                key, new = (row["i"], row["j"], row["part"]), _unpacked(row)
                if key != now:
                    if now is not None:
                        yield _packed(*now, held)
                    now, held = key, new
                else:
                    held = _merged(held, new)
        if now is not None:
            yield _packed(*now, held)

    def finish(batches):
        for batch in batches:
            for row in batch.to_pylist():
                _, _, _, products, left, right = _unpacked(row)
                with np.errstate(divide="ignore", invalid="ignore"):
                    found = products / np.sqrt(np.outer(left, right))
                if row["i"] == row["j"]:
                    np.fill_diagonal(found, np.where(left > 0, 1.0, np.nan))
                i, j = np.indices(found.shape)
                yield pa.RecordBatch.from_arrays(
                    [pa.array((i + row["i"] * block).ravel()), pa.array((j + row["j"] * block).ravel()), pa.array(found.ravel())],
                    names=["i", "j", "correlation"],
                )

    other = packed.select("strip", F.col("at").alias("j"), F.col("rows").alias("right"))
    pairs = packed.select("strip", F.col("at").alias("i"), F.col("rows").alias("left")).join(other, "strip").where("i <= j")
    partial = pairs.select("i", "j", "left", "right").mapInArrow(sums, _SUMS)
    for parts in (F.col("part"), F.lit(0)):
        # Streamed through, one pair and part after the other.
        partial = partial.withColumn("part", parts).repartition("i", "j", "part").sortWithinPartitions("i", "j", "part")
        partial = partial.mapInArrow(merge, _SUMS)
    found = partial.mapInArrow(finish, "i long, j long, correlation double")
    named = F.array(*map(F.lit, names))
    name = lambda at: F.get(named, F.col(at).cast("int"))
    both = F.array(F.struct(name("i").alias("left"), name("j").alias("right")), F.struct(name("j").alias("left"), name("i").alias("right")))
    # Blocks on the diagonal hold both orders already.
    same = F.floor(F.col("i") / block) == F.floor(F.col("j") / block)
    return found.select(F.inline(F.when(same, F.slice(both, 1, 1)).otherwise(both)), "correlation")


_SUMS = "i int, j int, part int, n long, a binary, b binary, products binary, left binary, right binary"


def _merged(one: list, other: list) -> list:
    """Rows, means of two blocks, sums of products and squares about them: of two sets of rows together."""
    n, a, b, products, left, right = one
    m, a2, b2, products2, left2, right2 = other
    both, da, db = n + m, a2 - a, b2 - b
    share = n * m / both
    return [
        both,
        a + da * (m / both),
        b + db * (m / both),
        products + products2 + np.outer(da, db) * share,
        left + left2 + da**2 * share,
        right + right2 + db**2 * share,
    ]


def _packed(i: int, j: int, part: int, sums: list) -> pa.RecordBatch:
    n, *parts = sums
    arrays = [pa.array([x], pa.int32()) for x in (i, j, part)] + [pa.array([n], pa.int64())]
    arrays += [pa.array([np.ascontiguousarray(x).tobytes()], pa.binary()) for x in parts]
    return pa.RecordBatch.from_arrays(arrays, names=["i", "j", "part", "n", "a", "b", "products", "left", "right"])


def _unpacked(row: dict) -> list:
    a, b, products, left, right = (np.frombuffer(row[name]) for name in ("a", "b", "products", "left", "right"))
    return [row["n"], a, b, products.reshape(len(a), len(b)), left, right]
