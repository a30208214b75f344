from __future__ import annotations

import random

import pytest

from subscore.plans.subscribers import COLUMNS, OPTIONS
from subscore.session import build_session
from subscore.sources.tables import text_schema


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "subscore-tests",
        "local[8]",
        {
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def subscriber(number: int, rng: random.Random, **changes) -> dict:
    """One clean raw row; the label follows contract, tenure and charges."""
    row = {name: rng.choice(values) for name, values in OPTIONS.items()}
    tenure, charges = rng.randint(0, 72), round(rng.uniform(20, 120), 2)
    margin = (
        {"Month-to-month": 2.5, "One year": -1.0, "Two year": -3.0}[row["Contract"]]
        - 0.06 * (tenure - 36)
        + 0.03 * (charges - 70)
    )
    row |= {
        "customerID": f"C{number:05d}",
        "tenure": str(tenure),
        "MonthlyCharges": str(charges),
        "TotalCharges": str(round(tenure * charges, 2)),
        "Churn": "Yes" if margin + rng.gauss(0, 1) > 0 else "No",
    }
    return row | changes


@pytest.fixture(scope="session")
def subscriber_rows():
    rng = random.Random(5)
    return [subscriber(number, rng) for number in range(2000)]


@pytest.fixture(scope="session")
def subscribers(spark, subscriber_rows):
    names = [*COLUMNS, "Churn"]
    rows = [tuple(row[name] for name in names) for row in subscriber_rows]
    return spark.createDataFrame(rows, text_schema(names)).repartition(4).cache()


@pytest.fixture
def raw_frame(spark):
    """Function from row dicts to a raw table."""

    def build(rows: list[dict], label: bool = True):
        names = [*COLUMNS, "Churn"] if label else COLUMNS
        return spark.createDataFrame(
            [tuple(row.get(name) for name in names) for row in rows], text_schema(names)
        )

    return build
