"""Exact inner-product search through a pivot-distance index."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from subscore.session import scratch_path

#: Fixed bounds: vectors that pivots are drawn from, vectors of a block, queries of a block,
#: annuli described in one row of the index, annuli that one task of a query block expands.
SAMPLE = 4096
BLOCK = 4096
QUERIES = 512
INDEX = 1024
UNIT = 8


def whole_vectors(df: DataFrame, key: str, vector: str, scale: int) -> DataFrame:
    """(id, v): floor(scale * component) as longs, without rows that hold a null or non-finite one."""
    v = F.col(f"`{vector}`")
    usable = v.isNotNull() & F.col(f"`{key}`").isNotNull() & F.forall(
        v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) != float("inf"))
    )
    whole = F.transform(v, lambda x: F.floor(x.cast("double") * scale).cast("long"))
    return df.where(F.coalesce(usable, F.lit(False))).select(
        F.col(f"`{key}`").cast("long").alias("id"), whole.alias("v")
    )


def matrix(column: pa.ListArray, dims: int) -> np.ndarray:
    """Vectors as rows; missing last components are 0."""
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    if len(lengths) and (lengths == dims).all():
        return flat.reshape(-1, dims)
    rows = np.zeros((len(lengths), dims), np.int64)
    rows[np.arange(dims) < lengths[:, None]] = flat
    return rows


def top_of(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((ids, -scores))[:k]
    return ids[order], scores[order]


class Pivots:
    """Distances after one more coordinate has made all vectors equally long.

    With |x| = radius for every stored vector, |q - x|^2 = |q|^2 + radius^2 - 2 q.x, so the
    nearest vectors have the highest inner products.
    """

    def __init__(self, rows: np.ndarray, radius2: float):
        self.radius2 = radius2
        self.rows = self.lifted(rows)

    def lifted(self, rows: np.ndarray) -> np.ndarray:
        rows = rows.astype(np.float64)
        rest = np.sqrt(np.maximum(0.0, self.radius2 - (rows**2).sum(1)))
        return np.column_stack([rows, rest])

    def distances(self, lifted: np.ndarray) -> np.ndarray:
        square = (lifted**2).sum(1)[:, None] + (self.rows**2).sum(1) - 2 * lifted @ self.rows.T
        return np.sqrt(np.maximum(0.0, square))

    def of_queries(self, queries: np.ndarray) -> np.ndarray:
        rows = queries.astype(np.float64)
        return self.distances(np.column_stack([rows, np.zeros(len(rows))]))

    def bound(self, queries: np.ndarray, nearest: np.ndarray) -> np.ndarray:
        """Highest inner product at a distance of ``nearest`` or more, with room for rounding."""
        square = (queries.astype(np.float64) ** 2).sum(1) + self.radius2
        # A distance near 0 is off by up to 1e-8 of the radius.
        return (square - nearest**2) / 2 + 1e-7 * square + 1


def exact_top_k(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 10,
    key: str = "vec_id",
    vector: str = "embedding",
    scale: int = 1024,
    pivots: int = 64,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` highest integer inner products of each query.

    Components count as floor(``scale`` * component). Candidates are all rows of ``vectors``
    but those with the query's own id; ties go to the smaller id. Every row is indexed: it is
    keyed by its nearest of ``pivots`` pivots and its distance to that pivot, and lies in an
    annulus of at most 4,096 rows. Pivots are drawn from at most 4,096 vectors, which also give
    each query a first score that its k-th result cannot be below. Each block of 512 queries
    meets the limits of the annuli, 1,024 at a time, and only the pairs that the triangle
    inequality leaves become rows and have their vectors brought together. They are expanded
    from the nearest annulus on, and queries that the bound rules out by then are passed over.
    The result is exact; nothing but the sample is collected.

    Rows without id, and vectors that are null or hold a null or non-finite component, take
    no part on either side. Shorter vectors are filled up with zeros. Repeated rows are
    candidates as often as they are there; repeated queries count once. An empty table gives
    an empty result. Other columns are not looked at. Sums are 64-bit integers.
    """
    spark = vectors.sparkSession
    schema = "query_id long, vec_id long, score long"
    stored = whole_vectors(vectors, key, vector, scale)
    asked = whole_vectors(queries, key, vector, scale).dropDuplicates(["id"])
    square = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    limits = stored.agg(F.max(F.size("v")), F.max(square), F.count("*")).first()
    questions = asked.agg(F.max(F.size("v")), F.count("*")).first()
    if not limits[2] or not questions[1]:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    dims = max(1, limits[0], questions[0])
    radius2, count = float(limits[1]), limits[2]

    share = min(1 << 30, int(SAMPLE / 2 / count * (1 << 30)) + 1)
    drawn = (
        stored.where(F.pmod(F.xxhash64(F.lit(9), "id"), F.lit(1 << 30)) < share)
        .limit(SAMPLE)
        .toArrow()
        .combine_chunks()
    )
    sample_ids, sample = drawn.column("id").to_numpy(), matrix(_whole(drawn.column("v")), dims)
    if not len(sample):
        sample = np.zeros((1, dims), np.int64)
        sample_ids = np.array([np.iinfo(np.int64).min])
    index = Pivots(sample, radius2)
    index = Pivots(sample[_spread(index.rows, pivots)], radius2)
    if not drawn.num_rows:
        sample, sample_ids = sample[:0], sample_ids[:0]

    def keyed(batches):
        for batch in batches:
            near = index.distances(index.lifted(matrix(batch.column(1), dims)))
            pivot = near.argmin(1)
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array(pivot.astype(np.int32)),
                    pa.array(near[np.arange(len(near)), pivot]),
                ],
                names=["id", "v", "pivot", "distance"],
            )

    def annuli(batches):
        for number, (pivot, rows) in enumerate(_runs(batches, "pivot", BLOCK)):
            distance = rows.column("distance").to_numpy()
            yield _row(
                block=pa.scalar((TaskContext.get().partitionId() << 32) + number, pa.int64()),
                pivot=pa.scalar(pivot, pa.int32()),
                least=pa.scalar(float(distance.min()), pa.float64()),
                most=pa.scalar(float(distance.max()), pa.float64()),
                ids=pa.scalar(rows.column("id").to_numpy().tobytes(), pa.binary()),
                rows=pa.scalar(matrix(_whole(rows.column("v")), dims).tobytes(), pa.binary()),
            )

    def asked_block(rows):
        ids, wanted = rows.column("id").to_numpy(), matrix(_whole(rows.column("v")), dims)
        scores = _products(wanted, sample, radius2)
        floor = np.full(len(ids), -np.inf)
        for place, own in enumerate(ids):
            others = np.sort(scores[place][sample_ids != own])[::-1]
            if len(others) >= k:
                floor[place] = others[k - 1]
        return pa.Table.from_batches(
            [
                _row(
                    qblock=pa.scalar(rows.column("qblock")[0].as_py(), pa.int32()),
                    qids=pa.scalar(ids.tobytes(), pa.binary()),
                    queries=pa.scalar(wanted.tobytes(), pa.binary()),
                    floor=pa.scalar(floor.tobytes(), pa.binary()),
                )
            ]
        )

    blocks_path, queries_path = scratch_path(spark, "annuli"), scratch_path(spark, "queries")
    parts, n_blocks = max(1, round(count / BLOCK / 2)), max(1, round(questions[1] / QUERIES))
    (
        stored.mapInArrow(keyed, "id long, v array<long>, pivot int, distance double")
        .repartitionByRange(parts, "pivot", "distance", "id")
        .sortWithinPartitions("pivot", "distance", "id")
        .mapInArrow(annuli, "block long, pivot int, least double, most double, ids binary, rows binary")
        .write.parquet(blocks_path)
    )
    (
        asked.withColumn("qblock", F.pmod(F.xxhash64("id"), F.lit(n_blocks)).cast("int"))
        .groupBy("qblock")
        .applyInArrow(asked_block, "qblock int, qids binary, queries binary, floor binary")
        .write.parquet(queries_path)
    )
    blocks, wanted = spark.read.parquet(blocks_path), spark.read.parquet(queries_path)

    def reachable(batches):
        """The pairs of which at least one query can find something, and how near that is."""
        for batch in batches:
            for row in batch.to_pylist():
                q = np.frombuffer(row["queries"], np.int64).reshape(-1, dims)
                near, floor = index.of_queries(q), np.frombuffer(row["floor"])[:, None]
                numbers, pivot = np.frombuffer(row["numbers"], np.int64), np.frombuffer(row["pivots"], np.int32)
                least, most = np.frombuffer(row["leasts"]), np.frombuffer(row["mosts"])
                kept, gaps = np.zeros(len(numbers), bool), np.full(len(numbers), np.inf)
                for start in range(0, len(q), 128):
                    part = slice(start, start + 128)
                    gap = _gap(near[part][:, pivot], least, most)
                    fits = index.bound(q[part], gap.T).T >= floor[part]
                    kept |= fits.any(0)
                    gaps = np.minimum(gaps, np.where(fits, gap, np.inf).min(0))
                if kept.any():
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(numbers[kept]),
                            pa.array(np.full(int(kept.sum()), row["qblock"], np.int32)),
                            pa.array(gaps[kept]),
                        ],
                        names=["block", "qblock", "gap"],
                    )

    def expand(batches):
        """Best results of each query block over the annuli of this task, the nearest first."""
        found = {}
        for batch in batches:
            for row in batch.to_pylist():
                if row["queries"] is not None:
                    yield from _results(found)
                    found = {}
                    qids = np.frombuffer(row["qids"], np.int64)
                    q = np.frombuffer(row["queries"], np.int64).reshape(-1, dims)
                    near, floor = index.of_queries(q), np.frombuffer(row["floor"]).copy()
                    continue
                gap = _gap(near[:, row["pivot"]], row["least"], row["most"])
                alive = np.flatnonzero(index.bound(q, gap) >= floor)
                if not len(alive):
                    continue
                ids = np.frombuffer(row["ids"], np.int64)
                scores = _products(q[alive], np.frombuffer(row["rows"], np.int64).reshape(-1, dims), radius2)
                for place, own in zip(alive, scores):
                    good = np.flatnonzero((own >= floor[place]) & (ids != qids[place]))
                    if not len(good):
                        continue
                    old_ids, old = found.get(qids[place], (ids[:0], own[:0]))
                    best = top_of(np.append(old_ids, ids[good]), np.append(old, own[good]), k)
                    found[qids[place]] = best
                    if len(best[1]) == k:
                        floor[place] = max(floor[place], best[1][-1])
        yield from _results(found)

    def described(table: pa.Table) -> pa.Table:
        """The limits of about 1,024 annuli as one row."""
        names = {"block": np.int64, "pivot": np.int32, "least": np.float64, "most": np.float64}
        packed = {f"{name}s": table.column(name).to_numpy().astype(kind).tobytes() for name, kind in names.items()}
        packed["numbers"] = packed.pop("blocks")
        return pa.Table.from_pylist([{"slice": table.column("slice")[0].as_py(), **packed}])

    limits = blocks.select("block", "pivot", "least", "most")
    n_annuli = limits.count()
    n_slices, n_units = max(1, -(-n_annuli // INDEX)), max(1, -(-n_annuli // UNIT))
    slices = (
        limits.withColumn("slice", F.pmod(F.xxhash64("block"), F.lit(n_slices)))
        .groupBy("slice")
        .applyInArrow(described, "slice long, numbers binary, pivots binary, leasts binary, mosts binary")
    )
    # A block of the stated queries meets a row for each 1,024 annuli; pairs are made within.
    pairs_path = scratch_path(spark, "pairs")
    (
        wanted.withColumn("slice", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_slices - 1).cast("long"))))
        .join(slices, "slice")
        .select("qblock", "queries", "floor", "numbers", "pivots", "leasts", "mosts")
        .mapInArrow(reachable, "block long, qblock int, gap double")
        .withColumn("unit", F.pmod(F.xxhash64("block"), F.lit(n_units)).cast("int"))
        .write.parquet(pairs_path)
    )
    pairs = spark.read.parquet(pairs_path)
    nothing = F.lit(None).cast("binary")
    columns = ["qblock", "unit", "gap", "pivot", "least", "most", "ids", "rows", "qids", "queries", "floor"]
    # One copy of a block of queries for each unit of annuli, ahead of them.
    heads = pairs.select("qblock", "unit").distinct().join(wanted, "qblock").select(
        "qblock", "unit", F.lit(-1.0).alias("gap"), F.lit(-1).alias("pivot"), F.lit(0.0).alias("least"),
        F.lit(0.0).alias("most"), nothing.alias("ids"), nothing.alias("rows"), "qids", "queries", "floor",
    )
    bodies = pairs.join(blocks, "block").select(
        *columns[:8], *(nothing.alias(name) for name in ("qids", "queries", "floor"))
    )
    best = (
        heads.unionAll(bodies)
        .repartition("qblock", "unit")
        .sortWithinPartitions("qblock", "unit", "gap")
        .mapInArrow(expand, schema)
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _whole(column) -> pa.ListArray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column if isinstance(column, pa.ListArray) else column.cast(pa.list_(pa.int64()))


def _spread(rows: np.ndarray, most: int) -> list[int]:
    """Rows far from each other: each next one is farthest from those chosen."""
    far, chosen = np.full(len(rows), np.inf), []
    while len(chosen) < min(most, len(rows)) and far.any():
        chosen.append(int(far.argmax()))
        far = np.minimum(far, ((rows - rows[chosen[-1]]) ** 2).sum(1))
        far[chosen[-1]] = 0
    return chosen


def _gap(distance: np.ndarray, least: float, most: float) -> np.ndarray:
    """Least distance to anything in an annulus around a pivot at this distance."""
    return np.maximum(0.0, np.maximum(distance - most, least - distance))


def _products(queries: np.ndarray, rows: np.ndarray, radius2: float) -> np.ndarray:
    """Integer inner products; in floating point where that is exact for vectors of this length."""
    largest = float((queries.astype(np.float64) ** 2).sum(1).max(initial=0)) * radius2
    if largest < 2.0**104:
        return (queries.astype(np.float64) @ rows.astype(np.float64).T).astype(np.int64)
    return queries @ rows.T


def _row(**values: pa.Scalar) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([x.as_py()], x.type) for x in values.values()], names=list(values)
    )


def _runs(batches, column: str, most: int):
    """(value, table) of the rows in runs of one value of ``column``, at most ``most`` rows long."""
    held: list[pa.RecordBatch] = []
    value, size = None, 0
    for batch in batches:
        values = batch.column(batch.schema.get_field_index(column)).to_numpy()
        edges = [0, *(np.flatnonzero(values[1:] != values[:-1]) + 1), len(values)]
        for start, end in zip(edges, edges[1:]):
            while start < end:
                if held and (values[start] != value or size == most):
                    yield value, pa.Table.from_batches(held)
                    held, size = [], 0
                value = int(values[start])
                stop = min(end, start + most - size)
                held.append(batch.slice(start, stop - start))
                size += stop - start
                start = stop
    if held:
        yield value, pa.Table.from_batches(held)


def _results(found: dict):
    if found:
        sizes = [len(ids) for ids, _ in found.values()]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(np.fromiter(found, np.int64, len(found)), sizes)),
                pa.array(np.concatenate([ids for ids, _ in found.values()])),
                pa.array(np.concatenate([scores for _, scores in found.values()])),
            ],
            names=["query_id", "vec_id", "score"],
        )
