"""Counts and shares. Each is a partial + final hash aggregate."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F

from subscore.functions import is_missing, quoted


def distinct_values(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """(column, value): every non-null value of every column, as text, in one job."""
    texts = df.select(*[F.col(quoted(name)).cast("string").alias(name) for name in columns])
    return (
        texts.unpivot([], [F.col(quoted(name)) for name in texts.columns], "column", "value")
        .where(F.col("value").isNotNull())
        .distinct()
    )


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n"))


def null_counts(df: DataFrame) -> DataFrame:
    """(column, nulls): missing values per column; NaN counts."""
    counts = df.agg(
        *[
            F.count_if(is_missing(F.col(quoted(field.name)), field.dataType)).alias(field.name)
            for field in df.schema
        ]
    )
    return counts.unpivot([], [quoted(name) for name in df.columns], "column", "nulls")


def column_summary(df: DataFrame) -> DataFrame:
    """(position, column, type, non_null): the table's layout and its filled cells."""
    counts = df.agg(
        *[
            F.count_if(~is_missing(F.col(quoted(field.name)), field.dataType)).alias(field.name)
            for field in df.schema
        ]
    )
    layout = F.array(
        *[
            F.struct(
                F.lit(position).alias("position"),
                F.lit(field.name).alias("column"),
                F.lit(field.dataType.simpleString()).alias("type"),
                F.col(quoted(field.name)).alias("non_null"),
            )
            for position, field in enumerate(df.schema)
        ]
    )
    return counts.select(F.inline(layout))


def value_counts(df: DataFrame, column: str, drop_missing: bool = True) -> DataFrame:
    """(value, n), largest first, ties by value."""
    value = F.col(quoted(column))
    rows = df.where(~is_missing(value, df.schema[column].dataType)) if drop_missing else df
    counts = rows.groupBy(value.alias("value")).agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), "value")


def value_shares(df: DataFrame, column: str, drop_missing: bool = True) -> DataFrame:
    """(value, n, share): counts with their share of all rows, largest first."""
    value = F.col(quoted(column))
    rows = df.where(~is_missing(value, df.schema[column].dataType)) if drop_missing else df
    counts = rows.groupBy(value.alias("value")).agg(F.count("*").alias("n"))
    # One number, so the total never pulls the groups into one task as a window would.
    total = counts.agg(F.sum("n")).scalar()
    return counts.select("value", "n", (F.col("n") / total).alias("share")).orderBy(
        F.desc("n"), "value"
    )


def segment_shares(df: DataFrame, segment: str, column: str) -> DataFrame:
    """(segment, value, n, share, percent): shares of each value inside each segment."""
    value = F.col(quoted(column))
    counts = (
        df.where(~is_missing(value, df.schema[column].dataType))
        .groupBy(F.col(quoted(segment)).alias("segment"), value.alias("value"))
        .agg(F.count("*").alias("n"))
    )
    totals = counts.groupBy(F.col("segment").alias("of")).agg(F.sum("n").alias("total"))
    return counts.join(totals, F.col("segment").eqNullSafe(F.col("of"))).select(
        "segment",
        "value",
        "n",
        (F.col("n") / F.col("total")).alias("share"),
        F.bround(100.0 * F.col("n") / F.col("total")).cast("int").alias("percent"),
    )
