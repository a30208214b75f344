"""Dictionary lookups as literal maps."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, functions as F


def _literal_map(mapping: Mapping[Any, Any]) -> Column:
    return F.create_map(*[F.lit(part) for pair in mapping.items() for part in pair])


def map_values(column: Column, mapping: Mapping[Any, Any]) -> Column:
    """Value found under the column's value; NULL when there is none."""
    return F.try_element_at(_literal_map(mapping), column)


def substitute_values(column: Column, mapping: Mapping[str, Any]) -> Column:
    """Like :func:`map_values`, but values without an entry stay as they are (as text)."""
    texts = {key: str(value) for key, value in mapping.items()}
    return F.coalesce(map_values(column, texts), column.cast("string"))
