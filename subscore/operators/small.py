"""Joining rows with per-group figures without trusting the number of groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from subscore.session import scratch_path


def settle(df: DataFrame) -> DataFrame:
    """``df`` computed once and read back from the shared folder.

    What follows neither repeats its work nor guesses its size: Spark knows the bytes
    written, and broadcasts the table in a join only if they are few.
    """
    path = scratch_path(df.sparkSession, "figures")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def weighted(df: DataFrame, keys: list[str], value: Column) -> DataFrame:
    """(keys, x, n) with one row per input row that has a usable number."""
    rows = df.select(*keys, value.cast("double").alias("x"), F.lit(1).cast("long").alias("n"))
    return rows.where(F.col("x").isNotNull() & ~F.isnan("x"))


def attach(values: DataFrame, side: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Rows joined with the settled table's rows of the same group, NULL groups included.

    Where the table is too large to broadcast, AQE divides the rows of a hot group: both
    sides are shuffled for this join alone.
    """
    renamed = side.withColumnsRenamed({key: f"side_{key}" for key in keys})
    same_group = [F.col(key).eqNullSafe(F.col(f"side_{key}")) for key in keys]
    return values.join(renamed, same_group, how).drop(*[f"side_{key}" for key in keys])
