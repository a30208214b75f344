"""Hard negatives for anchors and their positives, by angles to reference directions.

The angle between two vectors lies between the difference and the sum of their angles to any
reference direction. With the norms, this bounds their inner product without looking at the
components, for single rows and for blocks of rows alike.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from subscore.llm.text import small_batches
from subscore.session import scratch_path, shared_root

#: Fixed bounds: vectors that reference directions are drawn from, rows and anchors of a block,
#: blocks of rows described in one row of the index, blocks of rows that one task of an anchor
#: block compares.
SAMPLE = 2048
ROWS = 4096
ANCHORS = 512
INDEX = 1024
UNIT = 8
#: Finite components count as this at most, so that sums of products stay exact.
LARGEST = 2.0**40


def whole(vector: Column, scale: int) -> Column:
    """floor(``scale`` * component) of each component, as longs."""
    near = lambda x: F.least(F.greatest(x.cast("double"), F.lit(-LARGEST)), F.lit(LARGEST))
    return F.transform(vector, lambda x: F.floor(near(x) * scale).cast("long"))


def usable(vector: Column) -> Column:
    """Whether a vector is there, and all its components are there and finite."""
    fine = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) != float("inf"))
    )
    return F.coalesce(vector.isNotNull() & fine, F.lit(False))


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Vectors as rows; missing last components are 0."""
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    if (lengths == dims).all():
        return flat.reshape(-1, dims)
    rows = np.zeros((len(lengths), dims), np.int64)
    rows[np.arange(dims) < lengths[:, None]] = flat
    return rows


def packed(rows: np.ndarray) -> bytes:
    """Whole numbers as bytes: the bytes of one number, then all of them as short as they fit."""
    largest = int(np.abs(rows).max(initial=0))
    kind = next(k for k in (np.int16, np.int32, np.int64) if largest <= np.iinfo(k).max)
    return bytes([np.dtype(kind).itemsize]) + rows.astype(kind).tobytes()


def unpacked(data: bytes, dims: int) -> np.ndarray:
    return np.frombuffer(data, f"i{data[0]}", offset=1).reshape(-1, dims).astype(np.int64)


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact inner products; in floating point where all partial sums are exact there."""
    longest = lambda rows: float(np.sqrt((rows.astype(np.float64) ** 2).sum(1).max(initial=0)))
    bound = longest(left) * longest(right)
    if bound < 2.0**52:
        return (left.astype(np.float64) @ right.astype(np.float64).T).astype(np.int64)
    if bound < 2.0**62:
        return left @ right.T
    exact = left.astype(object) @ right.astype(object).T
    limits = np.iinfo(np.int64)
    return np.clip(exact, limits.min, limits.max).astype(np.int64)


class Directions:
    """Reference directions, angles to them, and what the angles say about inner products."""

    def __init__(self, rows: np.ndarray):
        self.rows = rows

    def angles(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(angles to every direction, norms); the null vector is at right angles to all."""
        vectors = vectors.astype(np.float64)
        norms = np.sqrt((vectors**2).sum(1))
        cosines = vectors @ self.rows.T / np.where(norms > 0, norms, 1)[:, None]
        return np.arccos(np.clip(cosines, -1, 1)), norms

    @staticmethod
    def limits(own, own_norms, least, most, shortest, longest) -> tuple[np.ndarray, np.ndarray]:
        """Least and highest inner product of each vector with each range of vectors.

        ``own`` (vectors x directions) are angles; ``least`` and ``most`` (ranges x directions)
        hold the range's angles, ``shortest`` and ``longest`` its norms. Both results are
        (vectors x ranges), widened by more than any rounding: an angle is off by up to 1e-7
        near 0 or pi, which moves a product by less than 1e-6 of the norms.
        """
        shape = len(own), len(least)
        apart, together = np.zeros(shape), np.full(shape, np.pi)
        for at in range(own.shape[1]):
            angle = own[:, at, None]
            np.maximum(apart, angle - most[:, at], out=apart)
            np.maximum(apart, least[:, at] - angle, out=apart)
            np.minimum(together, angle + most[:, at], out=together)
            np.minimum(together, 2 * np.pi - angle - least[:, at], out=together)
        high, low = np.cos(apart), np.cos(np.maximum(together, apart))
        far, near = own_norms[:, None] * longest, own_norms[:, None] * shortest
        room = 1e-6 * far + 1
        return np.where(low > 0, low * near, low * far) - room, np.where(high > 0, high * far, high * near) + room


def directions_of(rows: np.ndarray, most: int) -> Directions:
    """``most`` directions of ``rows`` far from each other: each next one is farthest from the others."""
    norms = np.sqrt((rows.astype(np.float64) ** 2).sum(1))
    units = rows[norms > 0] / norms[norms > 0, None]
    chosen: list[int] = []
    near = np.full(len(units), -np.inf)
    while len(chosen) < min(most, len(units)):
        chosen.append(int(near.argmin()))
        near = np.maximum(near, np.abs(units @ units[chosen[-1]]))
    return Directions(units[chosen] if chosen else np.eye(1, max(1, rows.shape[1])))


def mine_hard_negatives(
    rows: DataFrame,
    anchors: Column,
    positives: int = 5,
    negatives: int = 5,
    least: int = 80,
    most: int = 100,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    scale: int = 256,
    references: int = 12,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Anchors are the rows of ``rows`` where ``anchors`` holds. A row's score is its integer inner
    product with the anchor, components counting as floor(``scale`` * component); higher scores
    come first, ties by smaller id. An anchor's positives are its first ``positives`` rows of
    the same label without those of its own id; for each of them come the first ``negatives``
    rows of another label with ``least`` * positive_score <= 100 * score <= ``most`` *
    positive_score, ranked from 1. The result is exact.

    1. Reference directions are drawn from at most 2,048 vectors. Every row is stored with its
       angles to them and its norm, in blocks of up to 4,096 rows that are close in label and
       angle; an index holds the ranges of each block.
    2. Each block of 512 anchors meets the index, 1,024 blocks of rows at a time: only blocks
       whose score bounds overlap the window of one of its anchors are brought to it. There the
       same bounds are taken row by row, and only rows inside a window get an integer score.
       Windows close as better rows are found.
    3. This is done for the positives first, then for the negatives, whose windows the scores
       of the positives fix.

    Work on a label, however common, and on an anchor block is dealt out by blocks of rows.
    Nothing but the sample is collected.

    Rows without id or label, and vectors that are null or hold a null or non-finite component,
    take no part. Shorter vectors are filled up with zeros; an empty one is the null vector.
    Finite components beyond 2^40 count as 2^40. Repeated rows are candidates as often as they
    are there; of several anchors with one id, that with the smallest label and vector counts.
    Where no row is left or no anchor, the result is empty. Other columns are not looked at,
    whatever their names. Sums are 64-bit integers.
    """
    spark = rows.sparkSession
    shared_root(spark)
    small_batches(spark)
    own = F.col(f"`{vector}`")
    stored = rows.where(F.col(f"`{key}`").isNotNull() & F.col(f"`{label}`").isNotNull() & usable(own)).select(
        F.col(f"`{key}`").cast("long").alias("id"),
        F.col(f"`{label}`").cast("long").alias("label"),
        whole(own, scale).alias("v"),
        F.coalesce(anchors, F.lit(False)).alias("anchor"),
    )
    limits = stored.agg(F.max(F.size("v")), F.count("*"), F.count_if("anchor")).first()
    if not limits[1] or not limits[2]:
        return spark.createDataFrame([], RESULT)
    dims, count, n_asked = max(1, limits[0]), limits[1], limits[2]
    share = min(1 << 30, int(SAMPLE / 2 / count * (1 << 30)) + 1)
    drawn = stored.where(F.pmod(F.xxhash64(F.lit(11), "id"), F.lit(1 << 30)) < share).limit(SAMPLE)
    sample = _Rows.of(drawn.toArrow(), dims)
    index = directions_of(sample.vectors, references)

    folder = scratch_path(spark, "angles")
    asked = stored.where("anchor").groupBy("id").agg(F.min(F.struct("label", "v")).alias("row"))
    asked = asked.select("id", "row.label", "row.v")
    _write_blocks(stored.drop("anchor"), index, dims, ROWS, count, f"{folder}/rows", _described)
    blocks = spark.read.parquet(f"{folder}/rows")
    n_slices = _write_index(blocks, f"{folder}/index")
    n_units = max(1, -(-count // (ROWS * UNIT)))

    def best(path: str, same: bool, wanted: int) -> DataFrame:
        """The first ``wanted`` rows of every window: (anchor, slot, id, score, rank)."""
        askers, slices = spark.read.parquet(path), spark.read.parquet(f"{folder}/index")
        (
            askers.drop("vectors", "ids")
            .withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(n_slices - 1))))
            .join(slices, "slice")
            .mapInArrow(_reachable(same), "ablock long, block long, gap double")
            .withColumn("unit", F.pmod(F.xxhash64("block"), F.lit(n_units)).cast("int"))
            .write.parquet(f"{path}-pairs")
        )
        pairs = spark.read.parquet(f"{path}-pairs")
        # A copy of an anchor block for each of its units, ahead of the blocks that it is compared with.
        heads = pairs.select("ablock", "unit").distinct().join(askers, "ablock").withColumn("gap", F.lit(float("-inf")))
        bodies = pairs.join(blocks.drop(*_RANGES), "block").withColumn("windows", F.lit(None).cast("binary"))
        columns = ["ablock", "unit", "gap", "ids", "labels", "vectors", "angles", "norms", "windows"]
        scored = (
            heads.select(*columns)
            .unionAll(bodies.select(*columns))
            .repartition("ablock", "unit")
            .sortWithinPartitions("ablock", "unit", "gap")
            .mapInArrow(_compare(dims, same, wanted), "anchor long, slot long, id long, score long")
        )
        order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "id")
        return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= wanted)

    def floors(anchor: _Rows, _) -> np.ndarray:
        """One window for each anchor, from the last score that the sample assures it of."""
        scores = products(anchor.vectors, sample.vectors)
        low = np.full(len(anchor.ids), NONE)
        for at in range(len(low)):
            others = scores[at][(sample.labels == anchor.labels[at]) & (sample.ids != anchor.ids[at])]
            if len(others) >= positives:
                low[at] = np.partition(others, -positives)[-positives]
        every = np.arange(len(low))
        return np.stack([every, np.zeros_like(every), low, np.full(len(low), np.iinfo(np.int64).max)])

    def given(_, table: pa.Table) -> np.ndarray:
        """The windows in column ``w``."""
        lists = _combined(table.column("w"))
        parts = lists.flatten()
        owners = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
        return np.stack([owners, *(parts.field(name).to_numpy() for name in ("slot", "low", "high"))])

    _write_blocks(asked, index, dims, ANCHORS, n_asked, f"{folder}/anchors", _asking(floors))
    best(f"{folder}/anchors", True, positives).write.parquet(f"{folder}/positives")
    close = spark.read.parquet(f"{folder}/positives").select(
        "anchor", F.col("rank").cast("long").alias("slot"), F.col("id").alias("positive_id"), "score"
    )
    # In whole numbers: from ceil(least / 100 * score) to floor(most / 100 * score).
    percent = lambda part: F.col("score").cast("decimal(30,0)") * F.lit(part).cast("decimal(7,0)") / 100
    bounds = close.select(
        "anchor", "slot", F.ceil(percent(least)).cast("long").alias("low"), F.floor(percent(most)).cast("long").alias("high")
    ).where("low <= high")
    windows = bounds.groupBy("anchor").agg(F.collect_list(F.struct("slot", "low", "high")).alias("w"))
    asking = asked.join(windows, F.col("id") == F.col("anchor")).select("id", "label", "v", "w")
    _write_blocks(asking, index, dims, ANCHORS, n_asked, f"{folder}/asking", _asking(given))
    found = best(f"{folder}/asking", False, negatives).select(
        "anchor", "slot", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score")
    )
    return found.join(close, ["anchor", "slot"]).select(
        F.col("anchor").alias("anchor_id"), "positive_id", "rank", "negative_id",
        F.col("score").alias("positive_score"), "negative_score",
    )


RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
#: A window without a lower limit.
NONE = np.iinfo(np.int64).min
#: Columns of a block of rows, and those of its ranges that the index holds.
_BLOCK = "ids binary, labels binary, vectors binary, angles binary, norms binary"
_RANGES = {"first": "<i8", "last": "<i8", "least": "<f8", "most": "<f8", "shortest": "<f8", "longest": "<f8"}


class _Rows:
    """Ids, labels and vectors of some rows."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        self.ids, self.labels, self.vectors = ids, labels, vectors

    @classmethod
    def of(cls, table: pa.Table, dims: int) -> _Rows:
        vectors = matrix(_combined(table.column("v")), dims) if table.num_rows else np.zeros((0, dims), np.int64)
        return cls(table.column("id").to_numpy(), table.column("label").to_numpy(), vectors)


def _combined(column: pa.ChunkedArray) -> pa.Array:
    return pa.concat_arrays([chunk for chunk in column.chunks])


def _described(rows: _Rows, _, angles: np.ndarray, norms: np.ndarray) -> dict[str, bytes]:
    """The ranges of a block of rows."""
    values = [rows.labels.min(), rows.labels.max(), angles.min(0), angles.max(0), norms.min(), norms.max()]
    return {name: np.asarray(x, kind).tobytes() for (name, kind), x in zip(_RANGES.items(), values)}


def _asking(windows: Callable[[_Rows, pa.Table], np.ndarray]):
    """The windows of a block of anchors: owner, slot, least and highest score of each."""
    return lambda rows, table, angles, norms: {"windows": windows(rows, table).astype(np.int64).tobytes()}


def _write_blocks(rows: DataFrame, index: Directions, dims: int, size: int, count: int, path: str, describe) -> None:
    """Write ``rows`` (id, label, v, ...) in blocks of ``size`` that are close in label and angle."""
    schema = rows.schema.simpleString()[len("struct<") : -1]
    more = [*_RANGES] if describe is _described else ["windows"]
    name = "block" if describe is _described else "ablock"

    def keyed(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            angles, _ = index.angles(matrix(batch.column("v"), dims))
            near = angles.argmin(1)
            own = angles[np.arange(len(near)), near]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(near.astype(np.int32)), pa.array(own)], names=[*batch.schema.names, "near", "angle"]
            )

    def packs(batches):
        for number, table in enumerate(_tables(batches, size)):
            found = _Rows.of(table, dims)
            angles, norms = index.angles(found.vectors)
            values = {
                name: (TaskContext.get().partitionId() << 32) + number,
                "ids": found.ids.tobytes(),
                "labels": found.labels.tobytes(),
                "vectors": packed(found.vectors),
                "angles": angles.tobytes(),
                "norms": norms.tobytes(),
                **describe(found, table, angles, norms),
            }
            yield pa.RecordBatch.from_pylist([values])

    (
        rows.mapInArrow(keyed, f"{schema}, near int, angle double")
        .repartitionByRange(max(1, round(count / size / 2)), "label", "near", "angle", "id")
        .sortWithinPartitions("label", "near", "angle", "id")
        .mapInArrow(packs, f"{name} long, {_BLOCK}, " + ", ".join(f"{x} binary" for x in more))
        .write.parquet(path)
    )


def _tables(batches, size: int):
    """The rows of a task in tables of ``size`` rows, the last one shorter."""
    held, rows = [], 0
    for batch in batches:
        while batch.num_rows:
            part = batch.slice(0, size - rows)
            batch = batch.slice(part.num_rows)
            held.append(part)
            rows += part.num_rows
            if rows == size:
                yield pa.Table.from_batches(held)
                held, rows = [], 0
    if held:
        yield pa.Table.from_batches(held)


def _write_index(blocks: DataFrame, path: str) -> int:
    """Write the ranges of about 1,024 blocks to a row; returns the number of rows."""
    names = ["block", *_RANGES]
    ranges = blocks.select(*names)
    n_slices = max(1, -(-ranges.count() // INDEX))

    def packs(table: pa.Table) -> pa.Table:
        values = {"slice": table.column("slice")[0].as_py(), "blocks": table.column("block").to_numpy().tobytes()}
        values |= {name: b"".join(table.column(name).to_pylist()) for name in _RANGES}
        return pa.Table.from_pylist([values])

    schema = "slice long, blocks binary, " + ", ".join(f"{name} binary" for name in _RANGES)
    sliced = ranges.withColumn("slice", F.pmod(F.xxhash64("block"), F.lit(n_slices)))
    sliced.groupBy("slice").applyInArrow(packs, schema).write.parquet(path)
    return n_slices


def _numbers(data: bytes, kind: str = "<i8", width: int | None = None) -> np.ndarray:
    values = np.frombuffer(data, kind)
    return values if width is None else values.reshape(-1, width)


def _limits_of(windows: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and highest score that any window of each anchor admits."""
    low, high = np.full(size, np.iinfo(np.int64).max), np.full(size, np.iinfo(np.int64).min)
    np.minimum.at(low, windows[0], windows[2])
    np.maximum.at(high, windows[0], windows[3])
    return low, high


def _reachable(same: bool):
    """From (anchor block, slice of the index) to the blocks of rows that some anchor can use."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                norms = _numbers(row["norms"], "<f8")
                angles, labels = _numbers(row["angles"], "<f8").reshape(len(norms), -1), _numbers(row["labels"])
                low, high = _limits_of(_numbers(row["windows"]).reshape(4, -1), len(norms))
                numbers = _numbers(row["blocks"])
                ranges = {name: _numbers(row[name], kind) for name, kind in _RANGES.items()}
                least, most = (ranges[name].reshape(len(numbers), -1) for name in ("least", "most"))
                reached, gaps = np.zeros(len(numbers), bool), np.full(len(numbers), np.inf)
                for start in range(0, len(norms), 128):
                    part = slice(start, start + 128)
                    bottom, top = Directions.limits(
                        angles[part], norms[part], least, most, ranges["shortest"], ranges["longest"]
                    )
                    own = labels[part, None]
                    if same:
                        fits = (ranges["first"] <= own) & (own <= ranges["last"])
                    else:
                        fits = (ranges["first"] != own) | (ranges["last"] != own)
                    fits &= (top >= low[part, None]) & (bottom <= high[part, None])
                    reached |= fits.any(0)
                    gaps = np.minimum(gaps, np.where(fits, -top, np.inf).min(0))
                if reached.any():
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(int(reached.sum()), row["ablock"])),
                            pa.array(numbers[reached]),
                            pa.array(gaps[reached]),
                        ],
                        names=["ablock", "block", "gap"],
                    )

    return run


def _compare(dims: int, same: bool, wanted: int):
    """Best rows of every window among the blocks of a unit, blocks with the highest bounds first."""

    def run(batches):
        held = None
        for batch in batches:
            for row in batch.to_pylist():
                if row["windows"] is not None:
                    if held is not None:
                        yield from held.results()
                    held = _Held(row, dims, wanted)
                else:
                    held.compare(row, same)
        if held is not None:
            yield from held.results()

    return run


class _Held:
    """An anchor block with its windows, and the best rows found for each."""

    def __init__(self, row: dict, dims: int, wanted: int):
        self.dims, self.wanted = dims, wanted
        self.ids, self.labels = _numbers(row["ids"]), _numbers(row["labels"])
        self.vectors, self.norms = unpacked(row["vectors"], dims), _numbers(row["norms"], "<f8")
        self.angles = _numbers(row["angles"], "<f8").reshape(len(self.norms), -1)
        self.windows = _numbers(row["windows"]).reshape(4, -1).copy()
        self.of = [np.flatnonzero(self.windows[0] == at) for at in range(len(self.ids))]
        self.found: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def compare(self, row: dict, same: bool) -> None:
        ids, labels, norms = _numbers(row["ids"]), _numbers(row["labels"]), _numbers(row["norms"], "<f8")
        angles = _numbers(row["angles"], "<f8").reshape(len(norms), -1)
        vectors = unpacked(row["vectors"], self.dims)
        for start in range(0, len(self.ids), 64):
            part = slice(start, start + 64)
            low, high = _limits_of(self.windows, len(self.ids))
            bottom, top = Directions.limits(self.angles[part], self.norms[part], angles, angles, norms, norms)
            fits = (labels == self.labels[part, None]) == same
            fits &= (ids != self.ids[part, None]) & (top >= low[part, None]) & (bottom <= high[part, None])
            asking, answering = np.flatnonzero(fits.any(1)), np.flatnonzero(fits.any(0))
            if not len(asking):
                continue
            # Integer scores of the rows inside a window of some anchor.
            scores = products(self.vectors[part][asking], vectors[answering])
            for place, own in zip(asking, scores):
                inside = fits[place, answering]
                for window in self.of[start + place]:
                    good = inside & (own >= self.windows[2, window]) & (own <= self.windows[3, window])
                    if good.any():
                        self.keep(window, ids[answering][good], own[good])

    def keep(self, window: int, ids: np.ndarray, scores: np.ndarray) -> None:
        old_ids, old = self.found.get(window, (ids[:0], scores[:0]))
        ids, scores = np.append(old_ids, ids), np.append(old, scores)
        best = np.lexsort((ids, -scores))[: self.wanted]
        self.found[window] = ids[best], scores[best]
        if len(best) == self.wanted:
            self.windows[2, window] = max(self.windows[2, window], scores[best[-1]])

    def results(self):
        if self.found:
            places = np.repeat(np.fromiter(self.found, np.int64), [len(x) for x, _ in self.found.values()])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(self.ids[self.windows[0][places]]),
                    pa.array(self.windows[1][places]),
                    pa.array(np.concatenate([x for x, _ in self.found.values()])),
                    pa.array(np.concatenate([x for _, x in self.found.values()])),
                ],
                names=["anchor", "slot", "id", "score"],
            )
