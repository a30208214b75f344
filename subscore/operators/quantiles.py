"""Exact quantiles, and what is built on them.

The built-in exact percentile keeps every distinct value of a group in one
task. Here two scans suffice whatever the distribution: the first takes
approximate percentiles a little below and above each wanted rank, whose rank
error is bounded; the second counts the rows below that bracket and, per value,
those inside it. These counts are added up by ranges of values, so that however
many values a bracket holds, no task ranks more than a range of them.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F

from subscore.functions import quoted
from subscore.operators.ranks import running_sums
from subscore.operators.small import attach, settle, weighted

ACCURACY = 10_000


def exact_quantiles(
    df: DataFrame,
    columns: Iterable[str],
    probabilities: Iterable[float],
    by: str | None = None,
    accuracy: int = ACCURACY,
) -> DataFrame:
    """(group,) column, probability, value — linear between the two closest ranks.

    NULL and NaN are left out. A rank is bracketed by percentiles with a rank error of
    1 / ``accuracy`` of the rows, so at most about 6 / ``accuracy`` of a group's rows lie in a
    bracket; of groups with fewer than 10 * ``accuracy`` rows, all do. Their values are ranked by
    ranges, each in a task of its own.
    """
    names, wanted = list(columns), [float(p) for p in probabilities]
    keys = [] if by is None else ["group"]
    numbers = df.select(
        *[F.col(quoted(by)).alias(key) for key in keys],
        *[F.col(quoted(name)).cast("double").alias(f"x{i}") for i, name in enumerate(names)],
    )
    brackets = settle(_brackets(numbers, names, wanted, keys, accuracy))
    counted = settle(_count(numbers, names, wanted, brackets, keys))
    return _rank(counted, brackets, [*keys, "column"])


def _brackets(
    numbers: DataFrame, names: list[str], wanted: list[float], keys: list[str], accuracy: int
) -> DataFrame:
    """(group,) column, probability, lo, hi, rank, fraction; NULL where a bracket is open."""
    edge = 2.0 / accuracy
    # Each rank's lower and upper percentile, held to the range that the function takes.
    points = [min(max(p + side, 0.0), 1.0) for p in wanted for side in (-edge, edge)]
    found = []
    for i in range(len(names)):
        x = F.when(~F.isnan(f"x{i}"), F.col(f"x{i}"))
        found += [
            F.percentile_approx(x, points, accuracy).alias(f"q{i}"),
            F.count(x).alias(f"n{i}"),
        ]
    per_rank = []
    for i, name in enumerate(names):
        large = F.col(f"n{i}") >= 10 * accuracy
        for k, p in enumerate(wanted):
            lo, hi = (F.get(f"q{i}", F.lit(2 * k + end)) for end in (0, 1))
            position = F.lit(p) * (F.col(f"n{i}") - 1)
            per_rank.append(
                F.struct(
                    F.lit(name).alias("column"),
                    F.lit(p).alias("probability"),
                    F.when(large & F.lit(p > edge), lo).alias("lo"),
                    F.when(large & F.lit(p < 1 - edge), hi).alias("hi"),
                    F.floor(position).alias("rank"),
                    (position - F.floor(position)).alias("fraction"),
                    F.col(f"n{i}").alias("rows"),
                )
            )
    return (
        numbers.groupBy(*keys).agg(*found).select(*keys, F.inline(F.array(*per_rank))).where("rows > 0")
    )


def _count(
    numbers: DataFrame, names: list[str], wanted: list[float], brackets: DataFrame, keys: list[str]
) -> DataFrame:
    """(group,) column, probability, x, n: values inside a bracket, NULL for all below it."""
    per_rank = [(i, k) for i in range(len(names)) for k in range(len(wanted))]
    if keys:
        # One row per group: its limits by column and probability.
        limits = [
            F.max(F.when((F.col("column") == names[i]) & (F.col("probability") == wanted[k]), F.col(end))).alias(
                f"{end}{i}_{k}"
            )
            for i, k in per_rank
            for end in ("lo", "hi")
        ]
        rows = attach(numbers, settle(brackets.groupBy("group").agg(*limits)), keys)
        limit = lambda end, i, k: F.col(f"{end}{i}_{k}")
    else:
        # As many as columns times probabilities.
        few = {(r["column"], r["probability"]): r for r in brackets.collect()}
        rows = numbers
        limit = lambda end, i, k: F.lit(
            few[names[i], wanted[k]][end] if (names[i], wanted[k]) in few else None
        ).cast("double")
    # One scan, whatever the number of columns and ranks: each row is counted where it belongs.
    met = []
    for i, k in per_rank:
        x, lo, hi = F.col(f"x{i}"), limit("lo", i, k), limit("hi", i, k)
        value = F.when(lo.isNull() | (x >= lo), x)
        place = F.struct(F.lit(names[i]).alias("column"), F.lit(wanted[k]).alias("probability"), value.alias("x"))
        met.append(F.when(x.isNotNull() & ~F.isnan(x) & (hi.isNull() | (x <= hi)), place))
    return (
        rows.select(*keys, F.inline(F.array_compact(F.array(*met))))
        .groupBy(*keys, "column", "probability", "x")
        .agg(F.count("*").alias("n"))
    )


def _rank(counted: DataFrame, brackets: DataFrame, keys: list[str]) -> DataFrame:
    """Linear between the values of the two wanted ranks."""
    ranked = attach(running_sums(counted, [*keys, "probability"], "x", ["n"]), brackets, [*keys, "probability"])
    rank, before = F.col("rank"), F.col("before_n")
    covers = lambda r: (r >= before) & (r < before + F.col("n"))
    ends = ranked.groupBy(*keys, "probability", "fraction").agg(
        F.max(F.when(covers(rank), F.col("x"))).alias("lower"),
        F.max(F.when(covers(F.least(rank + 1, F.col("rows") - 1)), F.col("x"))).alias("upper"),
    )
    value = F.when(
        (F.col("lower") == F.col("upper")) | (F.col("fraction") == 0), F.col("lower")
    ).otherwise(F.col("lower") + (F.col("upper") - F.col("lower")) * F.col("fraction"))
    return ends.select(*keys, "probability", value.alias("value"))


def medians(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """(column, median) of numeric columns."""
    found = exact_quantiles(df, columns, [0.5])
    return found.select("column", F.col("value").alias("median"))


def _quartiles(df: DataFrame, column: str, by: str, **limits: int) -> DataFrame:
    found = exact_quantiles(df, [column], [0.25, 0.5, 0.75], by, **limits)
    at = {
        name: F.max(F.when(F.col("probability") == p, F.col("value"))).alias(name)
        for name, p in (("q1", 0.25), ("median", 0.5), ("q3", 0.75))
    }
    return settle(found.groupBy("group").agg(*at.values()))


def _fenced(df: DataFrame, column: str, by: str, reach: float, **limits: int) -> DataFrame:
    side = _quartiles(df, column, by, **limits)
    values = weighted(
        df.withColumn("group", F.col(quoted(by))), ["group"], F.col(quoted(column))
    )
    fence = reach * (F.col("q3") - F.col("q1"))
    inside = F.col("x").between(F.col("q1") - fence, F.col("q3") + fence)
    return attach(values, side, ["group"]).withColumn("inside", inside)


def box_stats(
    df: DataFrame, column: str, by: str, reach: float = 1.5, **limits: int
) -> DataFrame:
    """(group, n, q1, median, q3, whisker_low, whisker_high, outliers) per group.

    Whiskers end at the furthest values within ``reach`` quartile distances of
    the box, and never inside the box.
    """
    inside = F.col("inside")
    return (
        _fenced(df, column, by, reach, **limits)
        .groupBy("group", "q1", "median", "q3")
        .agg(
            F.sum("n").alias("n"),
            F.min(F.when(inside, F.col("x"))).alias("low"),
            F.max(F.when(inside, F.col("x"))).alias("high"),
            F.sum(F.when(~inside, F.col("n")).otherwise(0)).alias("outliers"),
        )
        .select(
            "group",
            "n",
            "q1",
            "median",
            "q3",
            F.least("low", "q1").alias("whisker_low"),
            F.greatest("high", "q3").alias("whisker_high"),
            "outliers",
        )
    )


def box_outliers(
    df: DataFrame, column: str, by: str, reach: float = 1.5, **limits: int
) -> DataFrame:
    """(group, value, n): the values beyond the fences, with how often each occurs."""
    return (
        _fenced(df, column, by, reach, **limits)
        .where(~F.col("inside"))
        .groupBy("group", F.col("x").alias("value"))
        .agg(F.sum("n").alias("n"))
    )
