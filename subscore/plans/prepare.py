"""Preparation of a raw subscriber table for the models."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F

from subscore.functions import quoted
from subscore.operators.encode import one_hot
from subscore.operators.prep import (
    cast_columns,
    complete,
    feature_columns,
    map_column,
    null_tokens,
    sort_columns,
)


@dataclass(frozen=True)
class TableSpec:
    """What the columns of a raw table mean."""

    key: str
    label: str
    types: Mapping[str, str]
    options: Mapping[str, list[str]]
    label_values: Mapping[str, int] = field(default_factory=dict)
    null_token: str = "?"

    @property
    def dummies(self) -> list[str]:
        return [f"{name}_{option}" for name, values in self.options.items() for option in values]

    @property
    def features(self) -> list[str]:
        return sorted([*self.types, *self.dummies])


def _typed(df: DataFrame, spec: TableSpec) -> DataFrame:
    typed = cast_columns(df, spec.types)
    if spec.label in df.columns:
        typed = cast_columns(map_column(typed, spec.label, spec.label_values), {spec.label: "int"})
    return typed


def clean(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Typed columns, label as a number if there is one, null tokens as NULL. Keeps all rows."""
    return null_tokens(_typed(df, spec), spec.null_token)


def prepare(df: DataFrame, spec: TableSpec, keep_key: bool = True) -> DataFrame:
    """Clean, drop rows with anything missing, encode, put columns in name order.

    The whole chain is narrow, so it works alike on tables and streams and costs
    one scan. The key stays so that a score never has to be matched by position.
    """
    # Rows with a null token go, so the text that is left needs no replacing. That keeps the
    # generated code short enough for the JVM to compile it.
    typed = _typed(df, spec)
    encoded = one_hot(typed.where(complete(typed, null_token=spec.null_token)), spec.options)
    return sort_columns(encoded if keep_key else encoded.drop(spec.key))


def prepare_encode_first(df: DataFrame, spec: TableSpec, keep_key: bool = True) -> DataFrame:
    """Encode before cleaning.

    A null token is then an ordinary category, and a NULL category survives as
    zeros; rows are dropped only for their other columns.
    """
    cleaned = clean(one_hot(df, spec.options), spec)
    kept = cleaned.where(complete(cleaned))
    return sort_columns(kept if keep_key else kept.drop(spec.key))


def rejects(df: DataFrame, spec: TableSpec) -> DataFrame:
    """The raw rows that :func:`prepare` drops, found in the same pass without a join."""
    flagged = _typed(df.withColumn("_raw", F.struct(*map(quoted, df.columns))), spec)
    kept = complete(flagged, df.columns, spec.null_token)
    return flagged.where(~kept).select("_raw.*")


def model_features(df: DataFrame, spec: TableSpec) -> list[str]:
    return feature_columns(df, {spec.key, spec.label})
