from __future__ import annotations

import random
from dataclasses import replace

import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from subscore.operators import prep
from subscore.operators.encode import (
    encode_sparse,
    learn_options,
    number_options,
    one_hot,
    one_hot_learned,
    one_hot_text,
)
from subscore.plans.prepare import clean, prepare, prepare_encode_first, rejects
from subscore.plans.subscribers import COLUMNS, OPTIONS, SUBSCRIBERS
from tests.conftest import subscriber

DROPPED = {
    "blank total": {"TotalCharges": " "},
    "null token": {"Contract": "?"},
    "unmapped label": {"Churn": "Maybe"},
    "null label": {"Churn": None},
    "null key": {"customerID": None},
    "NaN total": {"TotalCharges": "NaN"},
    "exponent tenure": {"tenure": "1e2"},
    "huge tenure": {"tenure": "99999999999"},
    "null category": {"gender": None},
}


def raw_row(**changes):
    return subscriber(1, random.Random(1), **changes)


def test_catalogue_size():
    assert (len(COLUMNS), len(OPTIONS)) == (20, 16)
    assert len(SUBSCRIBERS.dummies) == 43
    assert len(SUBSCRIBERS.features) == 46


@pytest.mark.parametrize("case", DROPPED)
def test_dirty_rows_are_dropped_and_reported(raw_frame, case):
    good, bad = raw_row(), raw_row(**({"customerID": "bad"} | DROPPED[case]))
    raw = raw_frame([good, bad, raw_row(customerID="later")])
    kept = prepare(raw, SUBSCRIBERS).select("customerID").collect()
    assert [row[0] for row in kept] == [good["customerID"], "later"]
    reported = rejects(raw, SUBSCRIBERS)
    assert reported.columns == raw.columns
    assert [row.asDict() for row in reported.collect()] == [{n: bad[n] for n in raw.columns}]


def test_kept_oddities(raw_frame):
    raw = raw_frame(
        [raw_row(tenure="12.7"), raw_row(tenure=".5"), raw_row(Contract="Weekly", tenure="3")]
    )
    rows = prepare(raw, SUBSCRIBERS).collect()
    assert [row["tenure"] for row in rows] == [12, 0, 3]
    assert [row[f"Contract_{o}"] for o in OPTIONS["Contract"] for row in rows[2:]] == [0, 0, 0]


def test_prepared_layout(subscribers):
    prepared = prepare(subscribers, SUBSCRIBERS, keep_key=False)
    assert prepared.columns == sorted([*SUBSCRIBERS.features, "Churn"])
    assert {t for n, t in prepared.dtypes if n in SUBSCRIBERS.dummies} == {"int"}
    unlabelled = prepare(subscribers.drop("Churn"), SUBSCRIBERS, keep_key=False)
    assert unlabelled.columns == SUBSCRIBERS.features
    one_per_column = [
        sum(F.col(f"`{name}_{option}`") for option in options).alias(name)
        for name, options in OPTIONS.items()
    ]
    sums = prepared.select(*one_per_column).distinct().collect()
    assert [set(row) for row in sums] == [{1}]


def test_preparation_is_one_narrow_scan(raw_frame):
    plan = prepare(raw_frame([raw_row()]), SUBSCRIBERS)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_encode_first_keeps_tokens_and_null_categories(raw_frame):
    raw = raw_frame(
        [
            raw_row(Contract="?"),
            raw_row(Contract=None),
            raw_row(TotalCharges="?"),
            raw_row(customerID="?"),
        ]
    )
    learned = {"Contract": learn_options(raw, ["Contract"], None)["Contract"]}
    assert learned["Contract"] == sorted({"?", raw_row()["Contract"]})
    rows = prepare_encode_first(raw, replace(SUBSCRIBERS, options=OPTIONS | learned)).collect()
    assert [row["Contract_?"] for row in rows] == [1, 0]
    assert rows[1][f"Contract_{raw_row()['Contract']}"] == 0


def test_options_learned_once_fit_other_tables(spark):
    train = spark.createDataFrame([(1, "b", 2.0), (0, "a", 3.0), (1, None, 4.0)], "n int, s string, x double")
    options = learn_options(train, ["s", "n"], max_options=5)
    assert options == {"s": ["a", "b"], "n": ["0", "1"]}
    other = spark.createDataFrame([(7, "b", 1.0), (1, "z", 1.0)], "n int, s string, x double")
    rows = one_hot(other, options).collect()
    assert [row.asDict() for row in rows] == [
        {"x": 1.0, "s_a": 0, "s_b": 1, "n_0": 0, "n_1": 0},
        {"x": 1.0, "s_a": 0, "s_b": 0, "n_0": 0, "n_1": 1},
    ]


def test_too_many_options_are_refused(spark):
    df = spark.range(50).select(F.col("id").cast("string").alias("id"), F.lit("x").alias("few"))
    with pytest.raises(ValueError, match="id"):
        learn_options(df, ["id", "few"], max_options=10)
    assert len(one_hot_learned(df, ["id"], max_options=50).columns) == 51


def test_columns_of_the_same_name_are_refused(spark):
    df = spark.createDataFrame([("y_z", "z")], "x string, x_y string")
    with pytest.raises(ValueError, match="x_y_z"):
        one_hot(df, {"x": ["y_z"], "x_y": ["z"]})


def test_text_columns_are_encoded_and_numbers_pass(spark):
    df = spark.createDataFrame([("u", 1, "p"), ("v", 2, "p")], "`a.b` string, n int, c string")
    encoded = one_hot_text(df, max_options=10)
    assert encoded.columns == ["n", "a.b_u", "a.b_v", "c_p"]
    assert [tuple(row) for row in encoded.orderBy("n").collect()] == [(1, 1, 0, 1), (2, 0, 1, 1)]


def test_small_operators(spark):
    df = spark.createDataFrame(
        [("k1", "1.5", "?", 1.0), ("k2", "x", "y", float("nan"))], "k string, n string, s string, d double"
    )
    assert [r[1] for r in prep.coerce_numbers(df, ["n"]).collect()] == [1.5, None]
    assert [r[2] for r in prep.null_tokens(df).collect()] == [None, "y"]
    assert [r[0] for r in prep.drop_null_rows(df).collect()] == ["k1"]
    assert [r[0] for r in prep.drop_null_rows(df, ["k", "n"]).collect()] == ["k1", "k2"]
    assert [r[0] for r in prep.filter_equal(df, "s", "y").collect()] == ["k2"]
    assert prep.drop_first_column(df).columns == ["n", "s", "d"]
    assert prep.sort_columns(df).columns == ["d", "k", "n", "s"]
    assert prep.feature_columns(df, {"k"}) == ["d", "n", "s"]
    assert [r[2] for r in prep.substitute_column(df, "s", {"y": 1}).collect()] == ["?", "1"]
    assert [r[2] for r in prep.map_column(df, "s", {"y": 1}).collect()] == [None, 1]
    assert clean(df.withColumnRenamed("k", "customerID"), SUBSCRIBERS_LIKE).columns[0] == "customerID"


SUBSCRIBERS_LIKE = type(SUBSCRIBERS)("customerID", "Churn", {"n": "double"}, {}, {})


def test_sparse_encoding(spark):
    rows = [(1, "b", 7), (2, None, 10), (3, "a", 9), (4, "ä", None), (5, "b", 7), (None, "", 8)]
    df = spark.createDataFrame(rows, "k int, `x.y` string, n int").repartition(3)
    options = number_options(df, ["x.y", "n"])
    assert {(r.column, r.option): r["index"] for r in options.collect()} == {
        ("x.y", ""): 0, ("x.y", "a"): 1, ("x.y", "b"): 2, ("x.y", "ä"): 3,
        ("n", "10"): 0, ("n", "7"): 1, ("n", "8"): 2, ("n", "9"): 3,
    }
    found = {r.k: r.features for r in encode_sparse(df, ["x.y", "n"]).collect()}
    wanted = {1: [2, 5], 2: [4], 3: [1, 7], 4: [3], 5: [2, 5], None: [0, 6]}
    assert {k: [int(i) for i in v.indices] for k, v in found.items()} == wanted
    assert {v.size for v in found.values()} == {8} and set(found[1].values) == {1.0}
    other = spark.createDataFrame([(1, "new", 9), (2, "a", 4)], "k int, `x.y` string, n int")
    encoded = {r.k: list(r.features.indices) for r in encode_sparse(other, ["x.y", "n"], options, "v").withColumnRenamed("v", "features").collect()}
    assert encoded == {1: [7], 2: [1]}
    assert encode_sparse(df.limit(0), ["n"]).collect() == []
    with pytest.raises(ValueError, match="features"):
        encode_sparse(df.withColumn("features", F.lit(1)), ["n"])


def test_a_million_options(spark):
    df = spark.range(1_000_000, numPartitions=4).select("id", F.concat(F.lit("o"), F.col("id")).alias("x"))
    found = encode_sparse(df, ["x"])
    place = F.unwrap_udt("features")["indices"][0]
    told = found.agg(F.count_distinct(place), F.min(place), F.max(place), F.max(F.unwrap_udt("features")["size"])).first()
    assert tuple(told) == (1_000_000, 0, 999_999, 1_000_000)
    in_order = found.where("x IS NOT NULL") if "x" in found.columns else found
    first = in_order.where(place == 0).first()
    assert first.id == 0


def test_models_take_sparse_vectors(spark):
    rows = spark.createDataFrame([(n, f"v{n % 7}", int(n % 7 > 3)) for n in range(200)], "k int, x string, y int")
    encoded = encode_sparse(rows, ["x"])
    scored = LogisticRegression(labelCol="y").fit(encoded).transform(encoded)
    assert scored.where("prediction <> y").isEmpty()
