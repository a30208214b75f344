"""Model selection from raw tables to saved models."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame

from subscore.plans.prepare import TableSpec, prepare
from subscore.plans.tune import Selection, search_families


def train(raw_train: DataFrame, raw_test: DataFrame, spec: TableSpec, **options: Any) -> list[Selection]:
    """Prepare both tables and run :func:`search_families` on them.

    ``options`` go there: families, spaces, trials, ratio, metric, greater_is_better, seed, save_to.
    """
    train_rows, test_rows = (prepare(raw, spec) for raw in (raw_train, raw_test))
    options.setdefault("keys", [spec.key])
    return search_families(train_rows, test_rows, spec.features, spec.label, **options)
