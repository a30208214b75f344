"""One-hot encoding of categorical columns."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, functions as F, types as T

from subscore.functions import quoted
from subscore.operators.prep import text_columns
from subscore.operators.profile import distinct_values
from subscore.operators.ranks import running_sums
from subscore.operators.small import attach, settle
from subscore.session import scratch_path


def one_hot(df: DataFrame, options: Mapping[str, Iterable[Any]]) -> DataFrame:
    """Replace every listed column by one 0/1 column per option.

    All columns are encoded in one projection. No option is left out; a value
    outside the options, and NULL, gives zeros throughout. Two columns of the same name
    (column ``x`` option ``y_z`` and column ``x_y`` option ``z``) are refused.
    """
    names = [name for name in df.columns if name not in options]
    names += [f"{name}_{option}" for name, values in options.items() for option in values]
    twice = sorted({name for name in names if names.count(name) > 1})
    if twice:
        raise ValueError(f"more than one column would be named {', '.join(twice)}")
    kept = [F.col(quoted(name)) for name in df.columns if name not in options]
    dummies = [
        _is(F.col(quoted(name)), option).cast("int").alias(f"{name}_{option}")
        for name, values in options.items()
        for option in values
    ]
    return df.select(*kept, *dummies)


def _is(column: Column, option: Any) -> Column:
    """True or false, also for NULL.

    Text options are compared as text, so that learned options fit numeric columns too.
    """
    return (column.cast("string") if isinstance(option, str) else column).eqNullSafe(option)


def learn_options(
    df: DataFrame, columns: Iterable[str], max_options: int | None
) -> dict[str, list[str]]:
    """Options of every column in the data, in text order, NULL left out.

    One job for all columns. Every option becomes a column of the encoded table, so the
    caller says how many a column may have: one with more is refused, not cut short, and the
    driver takes no more. None sets no limit, for columns known to be narrow.
    """
    columns = list(columns)
    found = distinct_values(df, columns)
    if max_options is not None:
        found = found.limit(max_options * len(columns) + 1)
    rows = found.collect()
    options: dict[str, list[str]] = {name: [] for name in columns}
    for row in rows:
        options[row["column"]].append(row["value"])
    if max_options is not None:
        too_wide = [name for name, values in options.items() if len(values) > max_options]
        if too_wide or len(rows) > max_options * len(columns):
            raise ValueError(f"more than {max_options} options in {too_wide or columns}")
    return {name: sorted(values) for name, values in options.items()}


def one_hot_learned(df: DataFrame, columns: Iterable[str], max_options: int | None) -> DataFrame:
    """One-hot with the options found in ``df`` itself."""
    return one_hot(df, learn_options(df, columns, max_options))


def one_hot_text(df: DataFrame, max_options: int | None) -> DataFrame:
    """One-hot every text column; columns of other types pass through."""
    return one_hot_learned(df, text_columns(df), max_options)


def number_options(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """(column, option, index): the options of every column as text, NULL left out, numbered from 0.

    Numbers follow text order within a column. They are counted over ranges of options, so a
    column may have any number of them: nothing is collected, and no task holds a column.
    """
    found = distinct_values(df, list(columns)).select("column", F.col("value").alias("option"), F.lit(1).alias("n"))
    numbered = running_sums(found.where("option IS NOT NULL"), ["column"], "option", ["n"])
    return settle(numbered.select("column", "option", F.col("before_n").alias("index")))


def encode_sparse(
    df: DataFrame, columns: Iterable[str], options: DataFrame | None = None, output: str = "features"
) -> DataFrame:
    """``df`` with the columns replaced by one sparse vector, a place per option of each column.

    ``options`` are those of :func:`number_options`, by default of ``df`` itself; those of a
    training table encode any other one alike. The places of the columns follow each other in
    the order given. A value outside the options, and NULL, gives zeros in its column's places;
    a column without options has no place. Rows meet the options of a column in a join whose
    size Spark knows: few are broadcast, many are shuffled, and a value that many rows share is
    divided. The driver takes one number per column.
    """
    names = list(columns)
    if output in [name for name in df.columns if name not in names]:
        raise ValueError(f"there is a column {output} already")
    options = number_options(df, names) if options is None else options
    sizes = {row["column"]: row["n"] for row in options.groupBy("column").agg((F.max("index") + 1).alias("n")).collect()}
    total, places, found = 0, [], df
    for at, name in enumerate(names):
        own = options.where(F.col("column") == name)
        side = own.select(F.col("option").alias(f"_option{at}"), F.col("index").alias(f"_index{at}"))
        found = attach(found.withColumn(f"_option{at}", F.col(quoted(name)).cast("string")), side, [f"_option{at}"], "left")
        places.append((F.col(f"_index{at}") + total).cast("int"))
        total += sizes.get(name, 0)
    indices = F.array_compact(F.array(*places)) if places else F.array().cast("array<int>")
    vector = F.struct(
        F.lit(0).cast("byte").alias("type"),
        F.lit(total).cast("int").alias("size"),
        indices.alias("indices"),
        F.transform(indices, lambda _: F.lit(1.0)).alias("values"),
    )
    kept = [name for name in df.columns if name not in names]
    packed = found.select(*map(quoted, kept), vector.alias(output))
    # A vector is stored as just this struct; reading it back makes it one without Python code.
    path = scratch_path(df.sparkSession, "vectors")
    packed.write.parquet(path)
    schema = T.StructType([*packed.schema.fields[:-1], T.StructField(output, VectorUDT())])
    return df.sparkSession.read.schema(schema).parquet(path)
