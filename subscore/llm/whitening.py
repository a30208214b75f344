"""Whitening of embeddings; eigenvalues are found by slicing the spectrum of their covariance."""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subscore.llm.hard_negatives import matrix, usable
from subscore.llm.text import small_batches
from subscore.session import scratch_path, shared_root

#: Added to every entry, so that entries are positive numbers far from zero.
OFFSET = 1_000_000
#: Finite components count as this at most, so that 64-bit numbers hold all entries.
LARGEST = 2.0**40
#: Bunch and Parlett's bound on the growth of entries.
GROWTH = (1 + 17**0.5) / 8
EPSILON = np.finfo(float).eps


# --- the spectrum of a symmetric matrix ----------------------------------------


def negative_pivots(a: np.ndarray) -> int:
    """How many eigenvalues of a symmetric matrix are negative: those of D in L D L^T have their signs.

    Pivots of one or two rows are chosen so that entries stay bounded; of a pivot of two rows
    exactly one eigenvalue is negative.
    """
    a, found = a.copy(), 0
    while len(a):
        diagonal = np.abs(np.diag(a))
        at = int(diagonal.argmax())
        off = np.abs(a - np.diag(np.diag(a)))
        i, j = divmod(int(off.argmax()), len(a))
        if not max(diagonal[at], off[i, j]):
            break
        if diagonal[at] >= GROWTH * off[i, j]:
            rest = np.delete(np.arange(len(a)), at)
            pivot, column = a[at, at], a[rest, at]
            found += pivot < 0
            a = a[np.ix_(rest, rest)] - np.outer(column / pivot, column)
        else:
            rest = np.delete(np.arange(len(a)), [i, j])
            both = [i, j]
            columns = a[np.ix_(rest, both)]
            found += 1
            a = a[np.ix_(rest, rest)] - columns @ np.linalg.solve(a[np.ix_(both, both)], columns.T)
        a = (a + a.T) / 2
    return found


class Spectrum:
    """Counts of the eigenvalues of a symmetric matrix above any number, by inertia."""

    def __init__(self, a: np.ndarray):
        self.a = a
        self.size = float(np.abs(a).sum(1).max(initial=0.0))
        #: Counts closer to an eigenvalue than this may be off by rounding.
        self.room = 16 * EPSILON * len(a) * max(self.size, np.finfo(float).tiny)

    def above(self, shift: float) -> int:
        return negative_pivots(shift * np.eye(len(self.a)) - self.a)

    def isolate(self, number: int) -> tuple[float, float, int, int]:
        """(low, high, first, last): a slice with the eigenvalue of this number, from 1 by falling size.

        The slice holds those numbered ``first`` to ``last``: one, or several that are too
        close to be told apart.
        """
        low, high = -self.size - 2 * self.room, self.size + 2 * self.room
        over_low, over_high = len(self.a), 0
        while over_low - over_high > 1 and high - low > 4 * self.room:
            low, high, over_low, over_high = self.halve(low, high, over_low, over_high, number)
        return low, high, over_high + 1, over_low

    def halve(self, low, high, over_low, over_high, number):
        middle = (low + high) / 2
        over = self.above(middle)
        return (middle, high, over, over_high) if over >= number else (low, middle, over_low, over)

    def solve(self, shift: float, right: np.ndarray) -> np.ndarray:
        shifted = self.a - shift * np.eye(len(self.a))
        try:
            found = np.linalg.solve(shifted, right)
        except np.linalg.LinAlgError:  # the shift is an eigenvalue
            found = np.linalg.solve(shifted + self.room * np.eye(len(self.a)), right)
        return found / np.sqrt((found**2).sum(0))

    def vector(self, number: int, low: float, high: float) -> tuple[float, np.ndarray]:
        """The single eigenvalue in a slice, by Rayleigh quotient iteration.

        An iteration that is led out of the slice starts again in a half as wide one.
        """
        random = np.random.default_rng(number)
        over_low, over_high = number, number - 1
        while True:
            x = self.solve((low + high) / 2, random.standard_normal(len(self.a)))
            x = self.solve((low + high) / 2, x)
            value, off = self.rayleigh(x)
            for _ in range(12):  # the error is cubed each time
                if off <= self.room or not low < value < high:
                    break
                x = self.solve(value, x)
                value, off = self.rayleigh(x)
            if low < value < high and off <= self.room:
                # Once more at the end, for the last digits of the vector.
                x = self.solve(value, x)
                return self.rayleigh(x)[0], x
            if high - low <= 4 * self.room:
                return value, x
            low, high, over_low, over_high = self.halve(low, high, over_low, over_high, number)

    def rayleigh(self, x: np.ndarray) -> tuple[float, float]:
        ax = self.a @ x
        value = float(x @ ax)
        return value, float(np.abs(ax - value * x).max())

    def cluster(self, low: float, high: float, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Eigenvalues too close to be told apart, and an orthonormal basis of their vectors."""
        basis = np.random.default_rng(size).standard_normal((len(self.a), size))
        for _ in range(3):
            basis = np.linalg.qr(self.solve((low + high) / 2, basis))[0]
        inner, turn = np.linalg.eigh(basis.T @ self.a @ basis)
        return inner[::-1], basis @ turn[:, ::-1]

    def certified(self, value: float, first: int, last: int) -> bool:
        """Whether exactly the eigenvalues ``first`` to ``last`` lie as near to ``value`` as rounding lets tell."""
        room = 8 * self.room
        return self.above(value + room) <= first - 1 < last <= self.above(value - room)

    def leading(self, most: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``most`` highest eigenvalues, falling, and their unit vectors as columns."""
        most = min(most, len(self.a))
        if not self.size:
            return np.zeros(most), np.eye(len(self.a))[:, :most]
        values, vectors = [], []
        while len(values) < most:
            low, high, first, last = self.isolate(len(values) + 1)
            if first == last:
                value, x = self.vector(first, low, high)
                found, basis = np.array([value]), x[:, None]
            else:
                found, basis = self.cluster(low, high, last - first + 1)
            for value, x in zip(found, basis.T):
                if not self.certified(float(value), first, last):
                    raise ArithmeticError(f"eigenvalue {first} is not certain to be {value}")
                # Vectors of very close eigenvalues are at right angles only up to rounding over their gap.
                for other in vectors:
                    x = x - other * (other @ x)
                x = x / np.sqrt(x @ x)
                values.append(float(value))
                vectors.append(x if x[np.abs(x).argmax()] > 0 else -x)
        return np.array(values[:most]), np.array(vectors[:most]).T.reshape(len(self.a), -1)


# --- covariance and projection of a table ---------------------------------------


@dataclass
class Whitening:
    """What the fit list says: its mean as ``centre + rest / n``, its covariance and components."""

    n: int
    centre: np.ndarray  # whole numbers
    rest: list[int]  # sums of x - centre
    covariance: np.ndarray
    values: np.ndarray
    vectors: np.ndarray

    @property
    def trace(self) -> float:
        return float(np.trace(self.covariance))

    @property
    def scaled(self) -> np.ndarray:
        """Components over the root of their eigenvalue; those without variance are NaN."""
        least = EPSILON * len(self.covariance) * max(self.trace, 0.0)
        roots = np.sqrt(np.where(self.values > least, self.values, np.nan))
        return self.vectors / roots

    def whitened(self, rows: np.ndarray) -> np.ndarray:
        """Rows of whole numbers, centred without rounding, then projected."""
        off = np.array([x / self.n for x in self.rest])
        return ((rows - self.centre).astype(np.float64) - off) @ self.scaled

    def deviations(self, rows: np.ndarray) -> list[int | None]:
        """Sum over the dimensions of (n x - S)^2, exactly; None beyond 64 bits."""
        off = rows - self.centre
        most = int(np.abs(off).max(initial=0)) * self.n + max((abs(x) for x in self.rest), default=0)
        kind = np.int64 if most * most * max(1, rows.shape[1]) < 2**62 else object
        off = off.astype(kind) * self.n - np.array(self.rest, kind)
        return [x if (x := int(square)) < 2**63 else None for square in (off * off).sum(1)]


def whole_entries(df: DataFrame, vector: str, scale: int, offset: int):
    """floor(``scale`` * entry) + ``offset`` of each entry of usable vectors, as ``x``."""
    own = F.col(f"`{vector}`")
    near = lambda x: F.least(F.greatest(x.cast("double"), F.lit(-LARGEST)), F.lit(LARGEST))
    x = F.transform(own, lambda entry: F.floor(near(entry) * scale).cast("long") + F.lit(offset).cast("long"))
    return df.where(usable(own)).withColumn("~x", x)


def product_sums(rows: np.ndarray) -> np.ndarray:
    """Sums over the rows of the products of every two columns, as exact whole numbers."""
    total = np.zeros((rows.shape[1], rows.shape[1]), object)
    largest = int(np.abs(rows).max(initial=0)) ** 2
    # So many products add up exactly in floating point.
    step = 2**52 // max(1, largest)
    if not step:
        return rows.astype(object).T @ rows.astype(object)
    for start in range(0, len(rows), step):
        part = rows[start : start + step].astype(np.float64)
        total += (part.T @ part).astype(np.int64)
    return total


def fit_whitening(fit: DataFrame, dims: int, components: int) -> Whitening | None:
    """The whitening of a list of vectors ``x`` (array<long>, each once); None if it is empty.

    Sums and products are whole numbers, added up on the executors; at most ``dims`` squared
    numbers leave them: first sums, whose mean gives a whole centre, then products of
    the entries about that centre. What is left of the mean is taken out exactly.
    """
    entries = fit.select(F.posexplode("x").alias("at", "entry"))
    sums = {r[0]: int(r[1]) for r in entries.groupBy("at").agg(F.sum(F.col("entry").cast("decimal(38,0)"))).collect()}
    n = fit.count()
    if not n or not dims:
        return None
    total = [sums.get(at, 0) for at in range(dims)]
    centre = np.array([x // n for x in total], np.int64)
    rest = [x - n * int(c) for x, c in zip(total, centre)]

    def centred(batches):
        exact = np.zeros((dims, dims), object)
        for batch in batches:
            if batch.num_rows:
                exact += product_sums(matrix(batch.column(0), dims) - centre)
        i, j = np.triu_indices(dims)
        totals = pa.array([Decimal(value) for value in exact[i, j]], pa.decimal128(38, 0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), totals], names=["i", "j", "total"]
        )

    made = fit.select("x").mapInArrow(centred, "i int, j int, total decimal(38,0)").groupBy("i", "j")
    exact = np.zeros((dims, dims), object)
    for i, j, value in made.agg(F.sum("total")).collect():
        exact[i, j] = exact[j, i] = int(value)
    off = np.array(rest, object)
    scaled = n * exact - np.outer(off, off)
    covariance = np.array([[value / (n * n) for value in row] for row in scaled.tolist()], float).reshape(dims, dims)
    values, vectors = Spectrum(covariance).leading(components)
    return Whitening(n, centre, rest, covariance, values, vectors)


def whiten(
    df: DataFrame,
    components: int = 16,
    key: str = "vec_id",
    vector: str = "embedding",
    scale: int = 64,
    offset: int = OFFSET,
) -> DataFrame:
    """(key, component, n, deviation, whitened, explained, identity_error) per usable row and component.

    Entries count as x = floor(``scale`` * entry) + ``offset``. The fit list has each distinct
    vector x once: n vectors with sums S and the covariance V about their mean, divisor n.
    Components are unit eigenvectors of V, numbered from 1 by falling eigenvalue e, their
    entry of the greatest size positive. ``deviation`` is the sum over the dimensions of
    (n x - S)^2; ``whitened`` is x - S/n on the component over the root of e; ``explained`` is
    e over the trace of V; ``identity_error``, one value for the table, is the largest
    entry of the difference between the covariance of ``whitened`` over the fit list and the
    identity.

    Inertia counts of V less a shift (L D L^T with pivots of one and two rows) halve the range
    of the spectrum until a slice holds one eigenvalue, Rayleigh quotients converge to it, and
    counts on both sides of it certify its number. Eigenvalues that counts cannot tell apart
    get an orthonormal basis of their common space. The driver holds V, the square of the
    number of dimensions, and nothing that grows with the rows.

    Rows whose vector is null or holds a null or non-finite entry are left out; rows without
    key stay. Shorter vectors are filled up with entries of 0. Finite entries beyond 2^40 count
    as 2^40. Repeated rows come out as often as they came in and count once in the fit list.
    Components without variance (one distinct vector, or fewer than components) have a null
    ``whitened``; ``identity_error`` is taken over the others, null if there is none. A
    ``deviation`` beyond 64 bits is null. An empty table gives an empty table, as do vectors
    without entries. Other columns are not looked at, whatever their names.
    """
    spark = df.sparkSession
    shared_root(spark)
    small_batches(spark)
    source = whole_entries(df, vector, scale, offset).select(F.col(f"`{key}`").alias(key), F.col("`~x`").alias("x"))
    dims = source.agg(F.max(F.size("x"))).first()[0] or 0
    result = (
        f"`{key}` {source.schema.fields[0].dataType.simpleString()}, component int, n long, deviation long, "
        "whitened double, explained double, identity_error double"
    )
    missing = F.array_repeat(F.lit(offset).cast("long"), F.lit(dims) - F.size("x"))
    filled = source.withColumn("x", F.when(F.size("x") < dims, F.concat("x", missing)).otherwise(F.col("x")))
    path = scratch_path(spark, "distinct")
    filled.select("x").distinct().write.parquet(path)
    fit = spark.read.parquet(path)
    fitted = fit_whitening(fit, dims, components)
    if fitted is None:
        return spark.createDataFrame([], result)
    error = identity_error(fit, fitted, dims)
    kept = len(fitted.values)
    explained = fitted.values / fitted.trace if fitted.trace > 0 else np.zeros(kept)
    numbers = np.arange(1, kept + 1, dtype=np.int32)

    def project(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 2048):
                part = batch.slice(start, 2048)
                rows = matrix(part.column(1), dims)
                each = np.repeat(np.arange(len(rows)), kept)
                deviations = pa.array(fitted.deviations(rows), pa.int64()).take(pa.array(each))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(each)),
                        pa.array(np.tile(numbers, len(rows))),
                        pa.array(np.full(len(each), fitted.n)),
                        deviations,
                        pa.array(fitted.whitened(rows).ravel(), from_pandas=True),
                        pa.array(np.tile(explained, len(rows))),
                        pa.array([error] * len(each), pa.float64()),
                    ],
                    names=[key, "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    named = filled.toDF("~0", "~1")
    return named.mapInArrow(project, result)


def identity_error(fit: DataFrame, fitted: Whitening, dims: int) -> float | None:
    """Largest entry of the covariance of the whitened fit list less the identity."""
    told = np.flatnonzero(~np.isnan(fitted.scaled).any(0))
    if not len(told):
        return None

    def sums(batches):
        total, products = np.zeros(len(told)), np.zeros((len(told), len(told)))
        for batch in batches:
            if batch.num_rows:
                rows = fitted.whitened(matrix(batch.column(0), dims))[:, told]
                total += rows.sum(0)
                products += rows.T @ rows
        table = np.vstack([products, total])
        i, j = np.indices(table.shape)
        yield pa.RecordBatch.from_arrays(
            [pa.array(i.ravel().astype(np.int32)), pa.array(j.ravel().astype(np.int32)), pa.array(table.ravel())],
            names=["i", "j", "total"],
        )

    made = fit.select("x").mapInArrow(sums, "i int, j int, total double").groupBy("i", "j").agg(F.sum("total"))
    table = np.zeros((len(told) + 1, len(told)))
    for i, j, value in made.collect():
        table[i, j] = value / fitted.n
    mean = table[-1]
    return float(np.abs(table[:-1] - np.outer(mean, mean) - np.eye(len(told))).max())
