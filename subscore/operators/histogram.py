"""Equal-width histograms over a whole column or within groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from subscore.functions import quoted
from subscore.operators.small import attach, settle, weighted


def _bin_of(x: Column, lo: Column, hi: Column, bins: int) -> Column:
    """0-based bin; each holds its left edge, the last one also its right edge.

    The quotient may land one bin off when a value sits on an edge, so the
    neighbours' edges decide.
    """
    step = (hi - lo) / bins
    first = F.least(F.floor((x - lo) / (hi - lo) * bins), F.lit(bins - 1)).cast("int")
    below = (x < first * step + lo).cast("int")
    above = ((x >= (first + 1) * step + lo) & (first < bins - 1)).cast("int")
    return first - below + above


def histogram(df: DataFrame, column: str, bins: int = 30, by: str | None = None) -> DataFrame:
    """(group,) bin, left, right, n — empty bins included.

    The range runs from the smallest to the largest value, within each group when
    ``by`` is given; a constant column gets a range of width one around it. NULL and
    NaN are left out; a range that ends at infinity has no bins, so that fails.
    Two passes over the column: one for the range, one for the counts.
    """
    keys = [] if by is None else ["group"]
    source = df if by is None else df.withColumn("group", F.col(quoted(by)))
    values = weighted(source, keys, F.col(quoted(column)))
    endless = F.raise_error(F.lit(f"the range of {column} is not finite"))
    limits = (
        values.groupBy(*keys)
        .agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
        .where("lo IS NOT NULL")
        .withColumn("lo", F.when(F.greatest(F.abs("lo"), F.abs("hi")) < float("inf"), F.col("lo")).otherwise(endless))
    )
    same = F.col("lo") == F.col("hi")
    half = F.when(same, 0.5).otherwise(0.0)
    limits = limits.select(
        *keys, (F.col("lo") - half).alias("lo"), (F.col("hi") + half).alias("hi")
    )
    side = settle(limits)
    ranged = attach(values, side, keys) if keys else _with_limits(values, side)
    lo, hi = F.col("lo"), F.col("hi")
    found = ranged.select(*keys, "lo", "hi", _bin_of(F.col("x"), lo, hi, bins).alias("bin"), "n")
    empty = side.select(
        *keys,
        "lo",
        "hi",
        F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"),
        F.lit(0).cast("long").alias("n"),
    )
    counted = found.unionByName(empty).groupBy(*keys, "lo", "hi", "bin").agg(F.sum("n").alias("n"))
    step = (hi - lo) / bins
    return counted.select(
        *keys,
        "bin",
        (F.col("bin") * step + lo).alias("left"),
        F.when(F.col("bin") == bins - 1, hi).otherwise((F.col("bin") + 1) * step + lo).alias("right"),
        "n",
    )


def _with_limits(values: DataFrame, side: DataFrame) -> DataFrame:
    limits = side.first() or {"lo": None, "hi": None}
    return values.withColumns(
        {name: F.lit(limits[name]).cast("double") for name in ("lo", "hi")}
    )
