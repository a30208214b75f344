from __future__ import annotations

import base64
import math

import pytest
from pyspark.sql import functions as F

from subscore.functions import (
    decode_base64,
    map_values,
    parse_json,
    sigmoid,
    substitute_values,
    to_double,
    to_int,
)
from subscore.sources.messages import parse_messages

TEXTS = [
    "12.7", "-3.", ".5", "+.5", ".", "-.", "1e2", "99999999999", "2147483648", "-2147483648",
    " 7 ", "\t8\n", "\x0112\x7f", "", "   ", "+", "-", "abc", "NaN", None, "007", "1.2.3", "1 2",
    "+5", "--5", "12L", "9" * 50, "0.999",
]


@pytest.fixture(params=["true", "false"])
def ansi(spark, request):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", request.param)
    yield
    spark.conf.set("spark.sql.ansi.enabled", before)


def test_casts_equal_the_lenient_cast(spark, ansi):
    texts = spark.createDataFrame([(text,) for text in TEXTS], "s string")
    setting = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    lenient = texts.select("s", F.col("s").cast("int"), F.col("s").cast("double")).collect()
    spark.conf.set("spark.sql.ansi.enabled", setting)
    ours = texts.select("s", to_int(F.col("s")), to_double(F.col("s"))).collect()
    assert [str(tuple(row)) for row in ours] == [str(tuple(row)) for row in lenient]


def test_map_values(spark, ansi):
    df = spark.createDataFrame([("Yes",), ("No",), ("Maybe",), (None,)], "s string")
    rows = df.select(
        map_values(F.col("s"), {"Yes": 1, "No": 0}),
        substitute_values(F.col("s"), {"Yes": 1, "No": 0}),
    ).collect()
    assert [tuple(row) for row in rows] == [(1, "1"), (0, "0"), (None, "Maybe"), (None, None)]


def test_base64_payloads_decode_row_by_row(spark):
    good = base64.b64encode('{"name": "Zoë"}'.encode()).decode()
    df = spark.createDataFrame([(good,), (f'"{good}"',), ("a",), ("",), (None,)], "d string")
    rows = [row[0] for row in df.select(decode_base64(F.col("d"))).collect()]
    assert rows == ['{"name": "Zoë"}', '{"name": "Zoë"}', None, "", None]


def test_base64_ignores_quotes_and_line_breaks_only(spark):
    good = base64.b64encode(b"a longer text").decode()
    texts = [f"{good[:6]}\r\n{good[6:]}", f"'{good}' ", f"{good[:6]}*{good[6:]}", f"é{good}"]
    df = spark.createDataFrame([(text,) for text in texts], "d string")
    rows = [row[0] for row in df.select(decode_base64(F.col("d"))).collect()]
    assert rows == ["a longer text", "a longer text", None, None]


def test_arrays_of_objects_are_rows(spark):
    texts = ['[{"a": "1"}, {"a": "2", "b": "x"}]', '{"a": "3"}', "[no", "[]", None]
    df = spark.createDataFrame([(text,) for text in texts], "data string")
    rows = sorted(map(tuple, parse_messages(df, ["a", "b"]).collect()), key=str)
    assert rows == sorted([("1", None), ("2", "x"), ("3", None)] + [(None, None)] * 3, key=str)


def test_json_keeps_unreadable_rows_as_nulls(spark):
    texts = ['{"a": "1", "b": 2}', '{"b": "x"}', "no json", "", None]
    df = spark.createDataFrame([(text,) for text in texts], "d string")
    rows = df.select(parse_json(F.col("d"), "a string, b string").alias("j")).select("j.*").collect()
    assert [tuple(row) for row in rows] == [("1", "2"), (None, "x")] + [(None, None)] * 3


def test_sigmoid(spark):
    df = spark.createDataFrame([(0.0,), (2.0,), (-800.0,)], "x double")
    got = [row[0] for row in df.select(sigmoid(F.col("x"))).collect()]
    assert got == pytest.approx([0.5, 1 / (1 + math.exp(-2)), 0.0])
