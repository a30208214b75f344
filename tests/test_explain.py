from __future__ import annotations

import hashlib
import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from subscore.plans import explain
from subscore.plans.explain import (
    Background,
    _different_pairs,
    _pooled,
    _walks,
    attributions,
    attributions_within,
    class_probability,
    explain_model,
    explain_models,
    explained_scorer,
    importance,
    probability_scorer,
    sample_background,
)
from subscore.plans.models import build_pipeline, fit_models
from subscore.plans.prepare import prepare
from subscore.plans.subscribers import SUBSCRIBERS
from subscore.plans.trees import Leaves, _Explainer, tree_attributions, tree_leaves

FEATURES = ["a", "b", "c.d"]


@pytest.fixture(scope="module")
def points(spark):
    rows = [(i, float(i % 3), i % 2, math.sin(i)) for i in range(30)]
    return spark.createDataFrame(rows, "k int, a double, b int, `c.d` double").cache()


def product_score(a, b, c):
    return a * b + 2 * c - 0.5 * a * c


def product_scorer(df):
    return df.withColumn("score", product_score(F.col("a"), F.col("b"), F.col("`c.d`")))


def exact(row, background):
    """Shapley values by all orders."""
    effects = dict.fromkeys(FEATURES, 0.0)
    orders = list(itertools.permutations(range(3)))
    for base in background:
        for order in orders:
            mixed = list(base)
            before = product_score(*mixed)
            for i in order:
                mixed[i] = row[i]
                after = product_score(*mixed)
                effects[FEATURES[i]] += (after - before) / (len(orders) * len(background))
                before = after
    return effects


def background_of(df, features=FEATURES):
    rows = df.select(*[F.col(f"`{name}`").cast("double") for name in features]).collect()
    return Background(list(features), [list(row) for row in rows])


@pytest.mark.parametrize("partitions", [None, 6])
def test_orders_and_reverses_are_exact_for_pairwise_effects(points, partitions):
    """An order and its reverse hold both orders of any two features."""
    background = background_of(points.orderBy("k").limit(5))
    found = attributions(points, background, ["k"], product_scorer, partitions=partitions).collect()
    assert len(found) == 30 * 3
    got = {(r["k"], r["feature"]): (r["value"], r["attribution"]) for r in found}
    for row in points.collect():
        for name, effect in exact(tuple(row[1:]), background.rows).items():
            assert got[row["k"], name] == (pytest.approx(row[name]), pytest.approx(effect, abs=1e-12))


def test_linear_scores_have_known_attributions(points):
    weights = {"a": 2.0, "b": -1.0, "c.d": 0.3}

    def scorer(df):
        return df.withColumn("score", sum(F.col(f"`{n}`") * w for n, w in weights.items()))

    some = points.where("k < 7")
    means = some.agg(*[F.avg(f"`{n}`").alias(n) for n in FEATURES]).first()
    found = attributions(points, background_of(some), ["k"], scorer, orders=3, seed=8)
    for row in found.collect():
        name = row["feature"]
        expected = weights[name] * (row["value"] - means[name])
        assert row["attribution"] == pytest.approx(expected, abs=1e-12)


def test_background_is_drawn_by_hash_from_all_rows(points):
    drawn = sample_background(points, FEATURES, ["k"], 6, seed=3)
    order = sorted(range(30), key=lambda k: hashlib.md5(f"3|{k}".encode()).hexdigest())[:6]
    rows = {row["k"]: list(map(float, row[1:])) for row in points.collect()}
    assert drawn.rows == [rows[k] for k in order]
    assert drawn == sample_background(points.repartition(7), FEATURES, ["k"], 6, seed=3)
    with pytest.raises(ValueError, match="background"):
        attributions(points, Background(FEATURES, []), ["k"], product_scorer)


def test_repeated_keys_fail(points):
    twice = points.unionByName(points.where("k = 3"))
    found = attributions(twice, background_of(points.limit(2)), ["k"], product_scorer)
    with pytest.raises(Exception, match="more than one row has the same k"):
        found.collect()


def test_no_join_and_sums_before_the_shuffle(points):
    background = background_of(points.where("k < 2"))
    for scorers in (product_scorer, {"one": product_scorer, "two": product_scorer}):
        found = attributions(points, background, ["k"], scorers)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert not any(word in plan for word in ("Join", "Cartesian", "Window", "Python"))
        assert "partial_sum" in plan and plan.count("Exchange hashpartitioning") == 1


@pytest.fixture(scope="module")
def prepared(subscribers):
    return prepare(subscribers, SUBSCRIBERS).cache()


@pytest.fixture(scope="module")
def models(prepared):
    settings = {"svm": {"regParam": 0.01, "maxIter": 20}, "gbdt": {"maxIter": 4, "maxDepth": 4, "seed": 1}}
    return {
        family: build_pipeline(family, SUBSCRIBERS.features, "Churn", **params).fit(prepared)
        for family, params in settings.items()
    }


def test_probability_of_both_kinds_of_model(prepared, models):
    scored = models["gbdt"].transform(prepared)
    row = scored.select("probability", class_probability(scored)).first()
    assert row[1] == row[0][1]
    scored = models["svm"].transform(prepared)
    row = scored.select("rawPrediction", class_probability(scored)).first()
    assert row[1] == pytest.approx(1 / (1 + math.exp(-row[0][1])))


def test_models_are_explained(prepared, models):
    background = sample_background(prepared, SUBSCRIBERS.features, ["customerID"], 6)
    base_rows = prepared.sparkSession.createDataFrame(
        [tuple(row) for row in background.rows], ", ".join(f"`{n}` double" for n in background.features)
    )
    found = explain_models(models, prepared, background, ["customerID"], n_samples=12, orders=2).cache()
    assert found.count() == 2 * 12 * 46
    for name, model in models.items():
        add_score = probability_scorer(model)
        first = prepared.orderBy("customerID")
        scores = {r["customerID"]: r["score"] for r in add_score(first.limit(12)).collect()}
        base = add_score(base_rows).agg(F.avg("score")).first()[0]
        sums = found.where(F.col("model") == name).groupBy("customerID").agg(F.sum("attribution"))
        for key, total in sums.collect():
            assert total == pytest.approx(scores[key] - base, abs=1e-9)
    top = importance(found.where("model = 'gbdt'"), 3).collect()
    assert len(top) == 3 and top[0]["importance"] >= top[2]["importance"]
    assert {r["feature"].split("_")[0] for r in top} <= {"Contract", "tenure", "MonthlyCharges", "TotalCharges"}
    per_model = importance(found, 2, by=["model"]).groupBy("model").count().collect()
    assert sorted(map(tuple, per_model)) == [("gbdt", 2), ("svm", 2)]


def test_explaining_every_row(prepared, models):
    some = prepared.where(F.col("customerID") < "C00020")
    background = sample_background(prepared, SUBSCRIBERS.features, ["customerID"], 2)
    found = explain_model(models["svm"], some, background, ["customerID"])
    assert found.count() == 20 * 46


def by_all_subsets(score, row, base):
    """Shapley values of each feature, from the score of every mix of two rows."""
    n = len(row)
    value = {
        inside: score([row[i] if i in inside else base[i] for i in range(n)])
        for size in range(n + 1)
        for inside in itertools.combinations(range(n), size)
    }
    found = []
    for i in range(n):
        total = 0.0
        for inside, worth in value.items():
            if i not in inside:
                share = math.factorial(len(inside)) * math.factorial(n - 1 - len(inside)) / math.factorial(n)
                total += share * (value[tuple(sorted((*inside, i)))] - worth)
        found.append(total)
    return found


@pytest.fixture(scope="module")
def tree_models(spark):
    rng = random.Random(2)
    rows = []
    for key in range(400):
        a, b, c, d = rng.random(), rng.randint(0, 3), rng.gauss(0, 1), float(rng.random() < 0.5)
        rows.append((key, a, b, c, d, int(a * b + c * d + rng.gauss(0, 0.3) > 1)))
    df = spark.createDataFrame(rows, "k int, a double, `b.b` int, c double, d double, y int").repartition(3).cache()
    names = ["a", "b.b", "c", "d"]
    settings = {"rf": ("rf", {"numTrees": 7, "maxDepth": 6, "seed": 1}), "gbdt": ("gbdt", {"maxIter": 6, "maxDepth": 4, "seed": 1})}
    plain = df.withColumnRenamed("b.b", "b_b")
    models = fit_models(plain, settings, ["a", "b_b", "c", "d"], "y")
    return plain, ["a", "b_b", "c", "d"], models, names


def test_trees_equal_all_subsets(spark, tree_models):
    df, features, models, _ = tree_models
    background = sample_background(df, features, ["k"], 9, seed=1)
    some = df.where("k < 25")
    found = tree_attributions(some, background, ["k"], models)
    assert found.columns == ["model", "k", "feature", "value", "attribution"]
    got = {(r.model, r.k, r.feature): r.attribution for r in found.collect()}
    assert len(got) == 2 * 25 * 4
    rows = {r.k: [float(r[name]) for name in features] for r in some.collect()}
    for name, model in models.items():
        leaves = tree_leaves(spark, model)
        score = lambda row: float(leaves.score(np.array([row], float))[0])  # noqa: B023, E731
        scored = explained_scorer(model)(some).collect()
        assert all(score(rows[r.k]) == pytest.approx(r.score, abs=1e-12) for r in scored)
        for key, row in rows.items():
            exact = np.mean([by_all_subsets(score, row, base) for base in background.rows], axis=0)
            assert [got[name, key, f] for f in features] == pytest.approx(exact.tolist(), abs=1e-10)


def test_trees_need_no_shuffle_and_keep_repeated_keys(spark, tree_models):
    df, features, models, _ = tree_models
    background = sample_background(df, features, ["k"], 3, seed=1)
    twice = df.where("k < 5").withColumn("k", F.lit(1))
    found = tree_attributions(twice, background, ["k"], models["rf"])
    assert found.columns == ["k", "feature", "value", "attribution"] and found.count() == 5 * 4
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString().split("Exchange RoundRobin")[0]
    with pytest.raises(ValueError, match="background"):
        tree_attributions(df, Background(features, []), ["k"], models)
    missing = df.where("k < 3").withColumn("a", F.lit(None).cast("double"))
    high = df.where("k < 3").withColumn("a", F.lit(math.inf))
    one, other = (sorted(map(tuple, tree_attributions(x, background, ["k"], models["rf"]).drop("value").collect())) for x in (missing, high))
    assert one == other
    assert tree_attributions(df.limit(0), background, ["k"], models).collect() == []


def test_a_tree_without_a_split_explains_nothing(spark):
    df = spark.createDataFrame([(1, 0.0, 1), (2, 1.0, 1), (3, 2.0, 0)], "k int, x double, y int")
    model = build_pipeline("rf", ["x"], "y", maxDepth=0, numTrees=2, seed=1).fit(df)
    found = tree_attributions(df, Background(["x"], [[0.5]]), ["k"], model).collect()
    assert [r.attribution for r in found] == [0.0] * 3


def test_forests_are_explained_by_their_leaves(tree_models):
    df, features, models, _ = tree_models
    background = sample_background(df, features, ["k"], 4, seed=1)
    some = df.where("k < 6")
    for boosted in ("probability", "margin"):
        found = explain_models(models, some, background, ["k"], boosted=boosted)
        base = df.sparkSession.createDataFrame([tuple(r) for r in background.rows], ", ".join(f"{f} double" for f in features))
        for name, model in models.items():
            add_score = explained_scorer(model, boosted)
            mean = add_score(base).agg(F.avg("score")).first()[0]
            scores = {r.k: r.score - mean for r in add_score(some).collect()}
            sums = dict(map(tuple, found.where(F.col("model") == name).groupBy("k").agg(F.sum("attribution")).collect()))
            assert sums == pytest.approx(scores, abs=1e-9)
    with pytest.raises(ValueError, match="margin"):
        explain_models(models, some, background, ["k"], boosted="class")


def test_sampling_stops_where_the_error_is_small(spark, points):
    """Three features that act together: errors are told, and only rows that need it are walked on."""
    background = background_of(points.where("k < 6"))
    seen = []

    def scorer(df):
        seen.append(df)
        return df.withColumn("score", F.col("a") * F.col("b") * F.col("`c.d`") * 10)

    def by_hand(row):
        score = lambda x: x[0] * x[1] * x[2] * 10
        return np.mean([by_all_subsets(score, row, base) for base in background.rows], axis=0)

    def within(limit):
        found = attributions_within(points, background, ["k"], scorer, limit, orders=14, rounds=2)
        return {(r.k, r.feature): r for r in found.collect()}

    loose = within(1e9)
    tight = within(float(np.median([r.error for r in loose.values() if r.error > 0])))
    assert len(loose) == len(tight) == 90 and len(seen) > 2
    assert sum(tight[at].error < loose[at].error for at in tight) > 20
    assert any(tight[at].error == loose[at].error > 0 for at in tight)  # small enough at first
    for row in points.collect():
        for name, effect in zip(FEATURES, by_hand([float(x) for x in row[1:]])):
            for found in (loose, tight):
                got = found[row.k, name]
                assert got.value == float(row[name]) and abs(got.attribution - effect) <= 6 * got.error + 1e-9
    # Effects of pairs are exact by an order and its reverse, so there is no error.
    exact = attributions_within(points, background, ["k"], product_scorer, 0.0, orders=2, rounds=3).collect()
    assert max(r.error for r in exact) < 1e-12
    with pytest.raises(ValueError, match="two orders"):
        attributions_within(points, background, ["k"], scorer, 1.0, orders=1)


def test_pooled_samples(spark):
    samples = [[1.0, 2.0, 4.0], [8.0, 9.0], [3.0]]
    rows = [("x", len(s), float(np.mean(s)), float(np.var(s) * len(s))) for s in samples]
    found = _pooled(spark.createDataFrame(rows, "k string, _n long, _mean double, _m2 double"), ["k"]).first()
    every = np.concatenate(samples)
    assert (found._n, found._mean) == (6, pytest.approx(every.mean()))
    assert found._m2 == pytest.approx(every.var() * 6)


def test_few_and_many_features_are_walked_alike(spark, points, monkeypatch):
    """One expression per feature gives what arrays give, also for missing numbers and equal rows."""
    rows = points.unionByName(points.where("k < 4").selectExpr("k + 100 AS k", "NULL AS a", "b", "`c.d`"))
    background = background_of(points.where("k < 5"))

    def twice(df):
        return df.withColumn("score", F.coalesce(F.col("a"), F.lit(7.0)) * 2 - F.col("b"))

    def found():
        got = attributions(rows, background, ["k"], {"one": product_scorer, "two": twice}, orders=2)
        return {(r.model, r.k, r.feature): (r.value, r.attribution) for r in got.collect()}

    narrow = found()
    monkeypatch.setattr(explain, "NARROW", 0)
    wide = found()
    assert narrow.keys() == wide.keys() and len(narrow) == 2 * 34 * 3
    for at, (value, effect) in narrow.items():
        assert value == wide[at][0]
        assert (effect is None) == (wide[at][1] is None)
        assert effect is None or effect == pytest.approx(wide[at][1], abs=1e-12)


def test_equal_orders_are_walked_once():
    drawn = _walks([[0.0, 0.0, 0.0]], 3, 64, seed=3)
    walks = _different_pairs(drawn, 5)
    assert len(drawn) == 128 and len(walks) == 6  # three orders of three features, and their reverses
    assert sorted(w["path"] for w in walks) == sorted(map(list, itertools.permutations(range(3))))
    assert sum(w["_drawn"] for w in walks) == 128 and {w["_background"] for w in walks} == {5}


def test_points_are_not_shuffled(spark, points, monkeypatch):
    """Sampling sends rows by their key before they are walked: below a scorer there is one exchange of rows."""
    plans = []

    def scorer(df):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return product_scorer(df)

    attributions_within(points, background_of(points.where("k < 3")), ["k"], scorer, 1e9, orders=4)
    assert len(plans) == 1 and plans[0].index("Generate") < plans[0].index("RepartitionByExpression")


def test_rows_between_the_same_limits_are_explained_once():
    inf = float("inf")
    leaves = Leaves(
        np.array([[0, 1], [0, 1], [0, 0]]), np.array([[-inf, -inf], [-inf, 2.0], [1.0, -inf]]),
        np.array([[1.0, 2.0], [1.0, inf], [inf, inf]]), np.array([1.0, 5.0, -3.0]),
    )
    rng = np.random.default_rng(1)
    rows = np.concatenate([rng.choice([0.0, 1.0, 2.0, 3.0], (500, 2)), [[inf, 0.0], [1.0, inf]]])
    explainer, seen = _Explainer(leaves, np.array([[0.0, 0.0], [2.0, 3.0]])), []
    plain = explainer._explain(rows)
    direct = explainer._explain
    explainer._explain = lambda some: seen.append(len(some)) or direct(some)
    for _ in range(2):
        assert explainer.explain(rows) == pytest.approx(plain, abs=1e-15)
    assert seen == [4, 0]
    assert explainer.explain(rows[:0]).shape == (0, 2)


@pytest.mark.parametrize("family", ["log_reg", "svm"])
@pytest.mark.parametrize("narrow", [True, False])
def test_linear_models_are_walked_without_points(prepared, family, narrow):
    """As by scoring every point; an array of effects comes from each row, whatever the number of walks."""
    features = ["MonthlyCharges", "TotalCharges", "tenure", "Contract_One year", "Contract_Two year"] if narrow else SUBSCRIBERS.features
    model = build_pipeline(family, features, "Churn", regParam=0.01, maxIter=20).fit(prepared)
    background = sample_background(prepared, features, ["customerID"], 4, seed=3)
    some = prepared.where("customerID < 'C00060'")
    scorer = probability_scorer(model)
    every = [
        {(r.customerID, r.feature): (r.value, r.attribution) for r in attributions(some, background, ["customerID"], s, orders=2, seed=5).collect()}
        for s in (scorer, lambda df: scorer(df))
    ]
    assert len(every[0]) == some.count() * len(features) and every[0].keys() == every[1].keys()
    for at, (value, attribution) in every[1].items():
        assert every[0][at] == (value, pytest.approx(attribution, abs=1e-10))
    plan = attributions(some, background, ["customerID"], scorer)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate ") == 1 and "UDF(" not in plan


def test_missing_numbers_of_linear_models(spark):
    """Refused like by the assembler, as is a key that comes twice, but of no matter to a model that does not use them."""
    df = spark.createDataFrame([(n, float(n % 5), float(n % 3), int(n % 5 > 2)) for n in range(60)], "k int, a double, b double, y int")
    scorer = probability_scorer(build_pipeline("log_reg", ["a", "b"], "y", regParam=0.1).fit(df))
    background = Background(["a", "b", "c"], [[1.0, 2.0, 0.0], [4.0, 0.0, 1.0]])
    odd = spark.createDataFrame([(1, 2.0, 1.0, 2.0), (None, 3.0, 2.0, None), (3, 4.0, 0.0, float("nan"))], "k int, a double, b double, c double")
    every = [
        {(r.k, r.feature): (str(r.value), r.attribution) for r in attributions(odd, background, ["k"], s).collect()}
        for s in (scorer, lambda df: scorer(df))
    ]
    assert len(every[0]) == 9 and every[0].keys() == every[1].keys()
    for at, (value, attribution) in every[1].items():
        assert every[0][at] == (value, pytest.approx(attribution, abs=1e-12))
    for missing in (float("nan"), None):
        with pytest.raises(Exception, match="missing or NaN"):
            attributions(odd.withColumn("a", F.lit(missing).cast("double")), background, ["k"], scorer).collect()
    with pytest.raises(Exception, match="more than one row"):
        attributions(df.withColumn("c", F.lit(0.0)).withColumn("k", F.lit(1)), background, ["k"], scorer).collect()
    gaps = Background(["a", "b"], [[1.0, None]])
    with pytest.raises(Exception):  # as the assembler refuses it
        attributions(df, gaps, ["k"], scorer).collect()
