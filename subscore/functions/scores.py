"""Score arithmetic on model output columns."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, functions as F


def sigmoid(column: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-column))


def vector_item(column: Column, position: int = 1) -> Column:
    """One element of a dense or sparse vector column."""
    return F.get(vector_to_array(column), F.lit(position))
