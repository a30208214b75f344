from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from subscore.operators import correlation
from subscore.operators.correlation import correlation_matrix, label_correlation, wide_correlation
from subscore.operators.histogram import histogram
from subscore.operators.profile import (
    column_summary,
    distinct_values,
    null_counts,
    row_count,
    segment_shares,
    value_counts,
    value_shares,
)
from subscore.operators.quantiles import box_outliers, box_stats, exact_quantiles, medians


@pytest.fixture
def gaps(spark):
    return spark.createDataFrame(
        [("a", 1.0, 1), ("a", float("nan"), None), (None, None, 2), ("b", 4.0, 2)],
        "`s.x` string, d double, n int",
    )


def test_counts(gaps):
    assert [tuple(r) for r in null_counts(gaps).collect()] == [("s.x", 1), ("d", 2), ("n", 1)]
    assert [tuple(r) for r in column_summary(gaps).collect()] == [
        (0, "s.x", "string", 3),
        (1, "d", "double", 2),
        (2, "n", "int", 3),
    ]
    assert row_count(gaps).first()[0] == 4
    assert [tuple(r) for r in value_counts(gaps, "s.x").collect()] == [("a", 2), ("b", 1)]
    assert [tuple(r) for r in value_counts(gaps, "s.x", False).collect()][0] == ("a", 2)
    shares = [tuple(r) for r in value_shares(gaps, "n").collect()]
    assert shares == [(2, 2, pytest.approx(2 / 3)), (1, 1, pytest.approx(1 / 3))]
    found = sorted(tuple(r) for r in distinct_values(gaps, ["s.x", "n"]).collect())
    assert found == [("n", "1"), ("n", "2"), ("s.x", "a"), ("s.x", "b")]


def test_empty_table(spark):
    empty = spark.createDataFrame([], "s string, x double")
    assert [tuple(r) for r in null_counts(empty).collect()] == [("s", 0), ("x", 0)]
    assert value_shares(empty, "s").collect() == []
    assert histogram(empty, "x").collect() == []
    assert histogram(empty, "x", by="s").collect() == []
    assert box_stats(empty, "x", "s").collect() == []


def test_segment_shares_keep_null_segments(spark):
    df = spark.createDataFrame([("a", 1), ("a", 0), ("a", 0), (None, 1)], "s string, y int")
    rows = {(r["segment"], r["value"]): (r["n"], r["percent"]) for r in segment_shares(df, "s", "y").collect()}
    assert rows == {("a", 1): (1, 33), ("a", 0): (2, 67), (None, 1): (1, 100)}


def test_shares_never_gather_all_groups_in_one_window(spark):
    plan = value_shares(spark.range(10), "id")._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


@pytest.fixture(scope="module")
def skewed(spark):
    """Three groups of which one holds most rows, with ties and a heavy tail."""
    rng = np.random.default_rng(3)
    frame = pd.DataFrame(
        {
            "g": rng.choice(["hot", "warm", "cold"], 6000, p=[0.8, 0.15, 0.05]),
            "x": np.where(rng.random(6000) < 0.3, 7.0, rng.lognormal(1, 2, 6000)),
            "t": rng.integers(0, 73, 6000).astype(float),
        }
    )
    return frame, spark.createDataFrame(frame).repartition(5).cache()


@pytest.mark.parametrize("column", ["x", "t"])
def test_histogram_equals_numpy(skewed, column):
    frame, df = skewed
    counts, edges = np.histogram(frame[column], 30)
    rows = histogram(df, column).orderBy("bin").collect()
    assert [row["n"] for row in rows] == counts.tolist()
    assert [row["left"] for row in rows] == pytest.approx(edges[:-1])
    assert [row["right"] for row in rows] == pytest.approx(edges[1:])


@pytest.fixture(params=["broadcast", "shuffled"])
def join_kind(request, spark):
    """Both ways of joining with group figures: few bytes, and too many to broadcast."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    if request.param == "shuffled":
        spark.conf.set(name, "-1")
    yield
    spark.conf.unset(name)


def test_grouped_histogram_equals_numpy(skewed, join_kind):
    frame, df = skewed
    rows = histogram(df, "t", by="g").orderBy("bin").collect()
    for group, part in frame.groupby("g"):
        counts, _ = np.histogram(part["t"], 30)
        assert [row["n"] for row in rows if row["group"] == group] == counts.tolist()


def test_histogram_counts_all_or_fails(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (float("nan"),), (None,)], "x double")
    assert sum(row["n"] for row in histogram(df, "x").collect()) == 2
    endless = df.unionByName(spark.createDataFrame([(float("inf"),)], "x double"))
    with pytest.raises(Exception, match="range of x is not finite"):
        histogram(endless, "x").collect()


def test_quantiles_take_as_many_jobs_whatever_the_distribution(spark):
    rng = np.random.default_rng(4)
    columns = {"even": rng.random(20_000), "tail": rng.lognormal(0, 4, 20_000)}
    jobs = []
    for name, values in columns.items():
        df = spark.createDataFrame(pd.DataFrame({"x": values}))
        spark.sparkContext.setJobGroup(name, name)
        rows = exact_quantiles(df, ["x"], [0.25, 0.5, 0.99], accuracy=200).collect()
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(name)))
        for row in rows:
            assert row["value"] == pytest.approx(np.quantile(values, row["probability"]))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[0] == jobs[1]


def test_histogram_of_a_constant(spark):
    rows = histogram(spark.range(5).select(F.lit(2).alias("x")), "x", bins=4).orderBy("bin").collect()
    assert [(row["left"], row["n"]) for row in rows] == [(1.5, 0), (1.75, 0), (2.0, 5), (2.25, 0)]


@pytest.mark.parametrize("limits", [{}, {"accuracy": 20}, {"accuracy": 100}])
def test_quantiles_equal_pandas(skewed, join_kind, limits):
    frame, df = skewed
    probabilities = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]
    rows = exact_quantiles(df, ["x", "t"], probabilities, by="g", **limits).collect()
    assert len(rows) == 3 * 2 * len(probabilities)
    expected = frame.groupby("g")[["x", "t"]].quantile(probabilities)
    for row in rows:
        assert row["value"] == pytest.approx(expected.loc[(row["group"], row["probability"]), row["column"]])


def test_quantiles_of_many_distinct_values_in_a_wide_bracket(spark):
    """Brackets of six hundredths of a million distinct values, ranked by ranges."""
    df = spark.range(1_000_000, numPartitions=4).select((F.col("id") * 7919 % 1_000_003).cast("double").alias("x"))
    values = np.arange(1_000_000) * 7919 % 1_000_003
    for row in exact_quantiles(df, ["x"], [0.25, 0.5, 0.999], accuracy=100).collect():
        assert row["value"] == pytest.approx(np.quantile(values, row["probability"]), rel=1e-12)


def test_quantiles_of_extreme_values(spark):
    values = [float("-inf"), -1.7e308, -1.0, -1.0, 5e-324, 1.0, 1.7e308, float("inf")]
    df = spark.createDataFrame([(v,) for v in [*values, None, float("nan")]], "x double")
    rows = exact_quantiles(df, ["x"], [i / 7 for i in range(8)], accuracy=1).collect()
    assert [r["value"] for r in sorted(rows, key=lambda r: r["probability"])] == values


def test_medians(skewed):
    frame, df = skewed
    rows = {row["column"]: row["median"] for row in medians(df, ["x", "t"]).collect()}
    assert rows == pytest.approx(frame[["x", "t"]].median().to_dict())


def test_box_stats(skewed, join_kind):
    frame, df = skewed
    rows = {row["group"]: row for row in box_stats(df, "x", "g").collect()}
    beyond = box_outliers(df, "x", "g").groupBy("group").agg(F.sum("n")).collect()
    for group, part in frame.groupby("g")["x"]:
        q1, q2, q3 = part.quantile([0.25, 0.5, 0.75])
        inside = part[part.between(q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1))]
        assert rows[group]["n"] == len(part)
        assert (rows[group]["q1"], rows[group]["median"], rows[group]["q3"]) == pytest.approx((q1, q2, q3))
        assert rows[group]["whisker_low"] == min(inside.min(), q1)
        assert rows[group]["whisker_high"] == max(inside.max(), q3)
        assert rows[group]["outliers"] == len(part) - len(inside)
        assert dict(map(tuple, beyond))[group] == len(part) - len(inside)


def test_quantile_plan_ranks_without_moving_rows(skewed):
    """Rows meet few brackets by broadcast; only counts are exchanged."""
    plan = exact_quantiles(skewed[1], ["x"], [0.5], by="g")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert "SortMergeJoin" not in plan


def test_correlation(skewed):
    frame, df = skewed
    encoded = df.select("x", "t", (F.col("g") == "hot").cast("int").alias("y"))
    frame = frame.assign(y=(frame["g"] == "hot").astype(int))[["x", "t", "y"]]
    expected = frame.corr()
    rows = label_correlation(encoded, "y", ["x", "t"]).collect()
    assert [row["column"] for row in rows] == list(expected["y"].sort_values(ascending=False).index)
    assert {row["column"]: row["correlation"] for row in rows} == pytest.approx(expected["y"].to_dict())
    for row in correlation_matrix(encoded, ["x", "t", "y"]).collect():
        assert row["correlation"] == pytest.approx(expected.loc[row["left"], row["right"]])


def test_wide_correlation(spark, monkeypatch):
    """Large means, several strips and blocks, columns without variance, rows with holes."""
    monkeypatch.setattr(correlation, "STRIP", 37)
    monkeypatch.setattr(correlation, "HELD", 2)
    rng = np.random.default_rng(8)
    data = rng.normal(0, 1, (500, 7)) @ rng.normal(0, 1, (7, 7)) + np.arange(7) * 1e7
    data[:, 4] = 3.0
    frame = pd.DataFrame(data, columns=list("abcdefg")).astype(object)
    frame.iloc[3, 1], frame.iloc[9, 2] = None, float("nan")
    df = spark.createDataFrame([tuple(r) for r in frame.itertuples(index=False)], ", ".join(f"{c} double" for c in frame))
    expected = pd.DataFrame(data, columns=list("abcdefg")).drop([3, 9]).corr()
    found = wide_correlation(df.repartition(3), list("abcdefg"), block=3).collect()
    assert len(found) == 49
    for row in found:
        assert row["correlation"] == pytest.approx(expected.loc[row["left"], row["right"]], abs=1e-9, nan_ok=True)
    assert wide_correlation(df.limit(0), ["a", "b"]).collect() == []


def test_two_thousand_columns_stay_on_the_executors(spark):
    names = [f"c{i}" for i in range(2000)]
    df = spark.range(1500, numPartitions=2).select(*[((F.col("id") * (i + 1)) % 101).alias(n) for i, n in enumerate(names)])
    found = wide_correlation(df, names).persist()
    same = found.where("left = right").agg(F.count("*"), F.min("correlation")).first()
    assert tuple(same) == (2000, 1.0)
    a, b = (np.arange(1500) * k % 101 for k in (3, 1999))
    pair = found.where("left = 'c1998' AND right = 'c2'").collect()
    assert [row["correlation"] for row in pair] == [pytest.approx(np.corrcoef(a, b)[0, 1])]
    found.unpersist()
