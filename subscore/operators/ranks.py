"""Running sums over any number of ordered rows, without a task that holds them all."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from subscore.operators.small import attach, settle


def running_sums(df: DataFrame, by: Sequence[str], order: str, sums: Sequence[str]) -> DataFrame:
    """``df`` with ``before_<name>`` for each of ``sums``: its total over the rows ahead in the group.

    Rows are ahead that have a smaller value of ``order`` (NULL first) and agree in the columns
    ``by``; ``order`` must be distinct within a group. Rows are dealt out by ranges of
    (by, order); the totals of each range are added up as prefixes, of which there is one row
    per group and range, and each range is then summed on its own. A group of any size is
    divided among as many tasks as it has ranges.
    """
    by = list(by)
    # The ranges must not change when they are read a second time, so they are written down.
    dealt = df.repartitionByRange(*by, order).withColumn("_range", F.spark_partition_id())
    ranged = settle(dealt)
    ahead = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy(*by, "_range").agg(*[F.sum(name).alias(name) for name in sums])
    prefixes = totals.select(
        *by, "_range", *[F.coalesce(F.sum(name).over(ahead), F.lit(0)).alias(f"_to_{name}") for name in sums]
    )
    within = (
        Window.partitionBy(*by, "_range")
        .orderBy(F.asc_nulls_first(order))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    inner = ranged.select(
        "*", *[F.coalesce(F.sum(name).over(within), F.lit(0)).alias(f"_in_{name}") for name in sums]
    )
    return attach(inner, settle(prefixes), [*by, "_range"]).select(
        *df.columns, *[(F.col(f"_to_{name}") + F.col(f"_in_{name}")).alias(f"before_{name}") for name in sums]
    )
