from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as contract
from subscore.workload import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"
TABLES = ["customer", "events", "lineitem", "orders"]


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def ordered(rows):
    return sorted(rows, key=lambda row: tuple((value is None, str(value)) for value in row))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, database, name):
    df = QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    quoted = ", ".join(f'"{column}"' for column in columns)
    expected = database.execute(f"SELECT {quoted} FROM ({ORACLES[name]})").fetchall()
    got = [tuple(row[column] for column in columns) for row in df.collect()]
    assert got
    assert ordered(got) == ordered(expected)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_other_queries_run(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_contract_holds_all_queries():
    assert QUERIES.items() <= contract.queries().items()
    assert ORACLES.items() <= contract.oracle_sql().items()


def test_entry(spark):
    scores = contract.entry(spark)
    assert scores.columns == ["o_orderkey", "prediction"]
    assert scores.count() > 1000
