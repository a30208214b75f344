"""Cleaning and projection operators. All are narrow: no shuffle, no job."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F, types as T

from subscore.functions import (
    change_type,
    is_missing,
    map_values,
    quoted,
    substitute_values,
)


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast columns in place; unreadable values become NULL."""
    return df.withColumns(
        {
            name: change_type(F.col(quoted(name)), df.schema[name].dataType, new)
            for name, new in types.items()
        }
    )


def coerce_numbers(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return cast_columns(df, {name: "double" for name in columns})


def map_column(df: DataFrame, column: str, mapping: Mapping[Any, Any]) -> DataFrame:
    """Replace values through a dictionary; values without an entry become NULL."""
    return df.withColumn(column, map_values(F.col(quoted(column)), mapping))


def substitute_column(df: DataFrame, column: str, mapping: Mapping[str, Any]) -> DataFrame:
    """Replace the listed values and keep all others."""
    return df.withColumn(column, substitute_values(F.col(quoted(column)), mapping))


def text_columns(df: DataFrame) -> list[str]:
    return [field.name for field in df.schema if isinstance(field.dataType, T.StringType)]


def null_tokens(df: DataFrame, token: str = "?") -> DataFrame:
    """NULL wherever a text column holds exactly ``token``."""
    return df.withColumns(
        {name: F.nullif(F.col(quoted(name)), F.lit(token)) for name in text_columns(df)}
    )


def complete(
    df: DataFrame, subset: Iterable[str] | None = None, null_token: str | None = None
) -> Column:
    """Condition: no column of ``subset`` (default: all) is NULL or NaN, or holds the token."""
    checks = []
    for name in df.columns if subset is None else subset:
        column, data_type = F.col(quoted(name)), df.schema[name].dataType
        if null_token is not None and isinstance(data_type, T.StringType):
            checks.append(~F.coalesce(column == F.lit(null_token), F.lit(True)))
        else:
            checks.append(~is_missing(column, data_type))
    return reduce(lambda left, right: left & right, checks, F.lit(True))


def drop_null_rows(df: DataFrame, subset: Iterable[str] | None = None) -> DataFrame:
    return df.where(complete(df, subset))


def filter_equal(df: DataFrame, column: str, value: Any) -> DataFrame:
    return df.where(F.col(quoted(column)) == F.lit(value))


def drop_first_column(df: DataFrame) -> DataFrame:
    return df.drop(df.columns[0])


def sort_columns(df: DataFrame) -> DataFrame:
    return df.select(*[quoted(name) for name in sorted(df.columns)])


def feature_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """Column names without ``exclude``, in name order so that fits are repeatable."""
    return sorted(set(df.columns) - set(exclude))
