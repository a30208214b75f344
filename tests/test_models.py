from __future__ import annotations

import pytest
from pyspark.ml.feature import StandardScalerModel
from pyspark.sql import functions as F

from subscore import workload
from subscore.functions import vector_item
from subscore.operators.metrics import area_under_roc, class_metrics
from subscore.operators.split import split_by_key
from subscore.plans import tune
from subscore.plans.evaluate import evaluate_models
from subscore.plans.models import TIMES, build_pipeline, counts_rows, fit, fit_models, fold
from subscore.plans.prepare import prepare
from subscore.plans.subscribers import SUBSCRIBERS
from subscore.plans.train import train
from subscore.plans.tune import (
    FOREST_SPACE,
    SPACES,
    Choice,
    Uniform,
    draw_params,
    rung_sizes,
    rungs_frame,
    search,
    selections_frame,
    trials_frame,
)
from subscore.sources.tables import load_model, save_model

SETTINGS = {
    "rf": {"numTrees": 20, "maxDepth": 6, "seed": 1},
    "gbdt": {"maxIter": 8, "maxDepth": 4, "seed": 1},
    "svm": {"regParam": 0.01, "maxIter": 30},
    "log_reg": {"regParam": 0.01},
}


@pytest.fixture(scope="module")
def parts(subscribers):
    train_rows, test_rows = split_by_key(prepare(subscribers, SUBSCRIBERS), ["customerID"])
    return train_rows.cache(), test_rows.cache()


@pytest.fixture(scope="module")
def models(parts):
    return {
        family: build_pipeline(family, SUBSCRIBERS.features, "Churn", **params).fit(parts[0])
        for family, params in SETTINGS.items()
    }


def f1(scored) -> float:
    return class_metrics(scored, "Churn").where("metric = 'f1'").first()["value"]


@pytest.mark.parametrize("family", SETTINGS)
def test_every_family_beats_the_majority_class(parts, models, family):
    majority = f1(parts[1].withColumn("prediction", F.lit(parts[1].agg(F.mode("Churn")).first()[0])))
    assert f1(models[family].transform(parts[1])) > majority + 0.15


@pytest.mark.parametrize("family", ["rf", "svm"])
def test_saved_model_scores_alike(models, parts, tmp_path, family):
    uri = f"file://{tmp_path}/model"
    save_model(models[family], uri)
    save_model(models[family], uri)
    before, after = (
        sorted(map(tuple, m.transform(parts[1]).select("customerID", "prediction").collect()))
        for m in (models[family], load_model(uri))
    )
    assert before == after


def test_scaler_only_where_needed(models):
    scaled = {f for f, m in models.items() if any(isinstance(s, StandardScalerModel) for s in m.stages)}
    assert scaled == {"svm", "log_reg"}
    assert len(build_pipeline("rf", ["a"], "y", scale=True).getStages()) == 3


def test_unknown_family():
    with pytest.raises(ValueError, match="unknown family"):
        build_pipeline("knn", ["a"], "y")


def test_drawn_parameters_stay_in_their_ranges():
    for family, space in {**SPACES, "forest": FOREST_SPACE}.items():
        drawn = draw_params(space, 200, seed=2)
        assert drawn == draw_params(space, 200, seed=2) != draw_params(space, 200, seed=3)
        for params in drawn:
            for name, value in params.items():
                sampler = space[name]
                if isinstance(sampler, Choice):
                    assert value in sampler.values
                else:
                    assert sampler.low < value <= sampler.high, family
    with pytest.raises(ValueError, match="trials"):
        draw_params(SPACES["rf"], 0)


def test_search_keeps_the_best_and_refits(parts, tmp_path):
    space = {
        "regParam": Choice([0.001, 0.3]),
        "elasticNetParam": Uniform(0.0, 0.3),
        "maxIter": Choice([10]),
    }
    uri = f"file://{tmp_path}/best"
    features = SUBSCRIBERS.features
    first, again = (
        search(*parts, "log_reg", features, "Churn", space, trials=3, seed=4, save_to=uri)
        for _ in range(2)
    )
    assert first.trials == again.trials and first.test == again.test
    assert len(first.trials) == 3
    values = [value for _, value in first.trials]
    assert first.validation == max(values)
    assert first.params == first.trials[values.index(max(values))][0]
    assert first.test == pytest.approx(f1(load_model(uri).transform(parts[1])))
    worst = search(
        *parts, "log_reg", features, "Churn", space, trials=2, seed=4, greater_is_better=False
    )
    assert worst.validation == min(values[:2])
    assert first.chosen == values.index(max(values))


def test_halving_finds_the_winner_of_all(parts):
    """Settings far apart: the best of all on all rows is the one that the rungs leave."""
    space = {"regParam": Uniform(0.0, 3.0), "elasticNetParam": Uniform(0.0, 1.0), "maxIter": Choice([20])}
    common = {"space": space, "trials": 12, "seed": 5, "keys": ["customerID"], "parallelism": 8}
    every = search(*parts, "log_reg", SUBSCRIBERS.features, "Churn", **common)
    halved = search(*parts, "log_reg", SUBSCRIBERS.features, "Churn", rungs=(1 / 4, 1 / 2, 1.0), **common)
    assert every.reached == [1] * 12 and sorted(halved.reached) == [1] * 8 + [2] * 2 + [3] * 2
    assert (halved.chosen, halved.params, halved.test) == (every.chosen, every.params, every.test)
    assert halved.validation == pytest.approx(every.validation)
    assert [n for _, n, _ in halved.rungs] == sorted({n for _, n, _ in halved.rungs})
    assert halved.rungs[-1] == every.rungs[0]
    last = {n for n, reached in enumerate(halved.reached) if reached == 3}
    assert halved.validation == max(halved.trials[n][1] for n in last)
    rungs = rungs_frame(parts[0].sparkSession, [halved]).orderBy("rung").collect()
    assert [row["trials"] for row in rungs] == rung_sizes(12, (1 / 4, 1 / 2, 1.0)) == [12, 4, 2]


def test_halving_takes_the_smallest_where_told(parts):
    space = {"regParam": Choice([0.001, 1000.0])}
    found = search(
        *parts, "log_reg", SUBSCRIBERS.features, "Churn", space, trials=4, seed=3, metric="hammingLoss",
        greater_is_better=False, rungs=(1 / 2, 1.0),
    )
    assert found.params == {"regParam": 0.001} and 0 < found.reached.count(2) < 4
    for rungs in ((), (0.5,), (1.0, 0.5), (0.0, 1.0)):
        with pytest.raises(ValueError, match="rungs"):
            search(*parts, "log_reg", SUBSCRIBERS.features, "Churn", space, trials=1, rungs=rungs)


def test_search_does_not_depend_on_partitioning(parts):
    space = {"regParam": Choice([0.001, 0.3])}
    few, many = (
        search(
            parts[0].repartition(n), parts[1], "log_reg", SUBSCRIBERS.features, "Churn", space,
            trials=2, keys=["customerID"],
        )
        for n in (3, 7)
    )
    assert few.params == many.params and few.test == pytest.approx(many.test)
    assert [v for _, v in few.trials] == pytest.approx([v for _, v in many.trials])


@pytest.mark.parametrize("family", SPACES)
def test_settings_of_the_whole_space_can_be_fitted(parts, family):
    some = parts[0].limit(300).cache()
    found = search(some, parts[1], family, SUBSCRIBERS.features, "Churn", trials=1, seed=6)
    assert 0 <= found.validation <= 1 and set(found.params) == set(SPACES[family])


def test_search_checks_its_arguments(parts):
    for wrong in ({"ratio": 1.0}, {"trials": 0}):
        with pytest.raises(ValueError):
            search(*parts, "rf", SUBSCRIBERS.features, "Churn", **wrong)


def test_training_from_raw_tables(spark, subscribers):
    spaces = {"svm": {"regParam": Uniform(0.0, 0.01)}, "rf": {"numTrees": Choice([5]), "maxDepth": Choice([4])}}
    raw_train, raw_test = split_by_key(subscribers, ["customerID"])
    found = train(
        raw_train, raw_test, SUBSCRIBERS, families=["svm", "rf"], spaces=spaces, trials=1
    )
    rows = selections_frame(spark, found).collect()
    assert [row["family"] for row in rows] == ["svm", "rf"]
    assert all(row["test"] > 0.6 for row in rows)
    assert trials_frame(spark, found).count() == 2


def test_model_comparison(parts, models):
    table = evaluate_models(models, parts[1], "Churn")
    values = {(row["model"], row["metric"]): row["value"] for row in table.collect()}
    assert len(values) == 20
    for family, model in models.items():
        scored = model.transform(parts[1])
        for row in class_metrics(scored, "Churn").collect():
            assert values[family, row["metric"]] == pytest.approx(row["value"])
        assert values[family, "roc_auc"] > 0.75


@pytest.fixture(scope="module")
def repeated(spark):
    """Few different rows, each many times, with a constant feature; and the same in counts."""
    rows = [(float(n % 3), float(n % 2), 1.0, int(n % 7 > 2 + n % 3)) for n in range(840)]
    return spark.createDataFrame(rows, "a double, `b.b` double, c double, y int").repartition(3).cache()


FEW = {"gbdt": {"maxIter": 5, "seed": 1}, "svm": {"regParam": 0.01}, "log_reg": {"regParam": 0.1, "elasticNetParam": 0.3, "tol": 1e-10}}


def test_equal_rows_are_fitted_once_and_counted(repeated):
    plain = repeated.withColumnRenamed("b.b", "b")
    few = fold(plain, ["a", "b", "c", "y"])
    assert few.count() <= 12 and few.agg(F.sum(TIMES)).first()[0] == 840
    assert fold(plain.withColumn("n", F.monotonically_increasing_id()), ["a", "n"]) is None
    for family, params in FEW.items():
        pipeline = build_pipeline(family, ["a", "b", "c"], "y", **params)
        assert counts_rows(pipeline)
        whole, counted = pipeline.fit(plain), fit(pipeline, few)
        assert [type(stage) for stage in whole.stages] == [type(stage) for stage in counted.stages]
        both = [
            {tuple(r)[:3]: (r.prediction, r.rawPrediction[1]) for r in model.transform(few).collect()}
            for model in (whole, counted)
        ]
        limit = 0.05 if family == "svm" else 1e-4  # an SVM is stopped after 100 steps
        for at, (prediction, margin) in both[0].items():
            assert both[1][at] == (prediction, pytest.approx(margin, abs=limit))
    assert not counts_rows(build_pipeline("rf", ["a"], "y"))
    assert not counts_rows(build_pipeline("svm", ["a"], "y", scale=False))
    assert not counts_rows(build_pipeline("gbdt", ["a"], "y", subsamplingRate=0.5))


def test_a_folded_table_has_a_part_for_many_rows(repeated):
    few = fold(repeated.withColumnRenamed("b.b", "b"), ["a", "b", "c", "y"]).persist()
    assert few.rdd.getNumPartitions() == 1
    few.unpersist()


def test_trials_of_a_search_share_what_is_in_front_of_the_learner(repeated, monkeypatch):
    """Each trial fits its learner alone; only the winner is fitted as a whole, once more."""
    plain = repeated.withColumnRenamed("b.b", "b").withColumn("k", F.monotonically_increasing_id())
    for family, folded in (("log_reg", True), ("log_reg", False), ("rf", False)):
        stages = []
        with monkeypatch.context() as patched:
            patched.setattr(
                tune, "fit", lambda pipeline, rows, params=None: stages.append(len(pipeline.getStages())) or fit(pipeline, rows, params)
            )
            if not folded:
                patched.setattr(tune, "fold", lambda rows, columns: None)
            space = {"regParam": Uniform(0.0, 0.3)} if family == "log_reg" else {"numTrees": Choice([3])}
            found = search(plain, plain, family, ["a", "b", "c"], "y", space, trials=3, keys=["k"])
        assert stages == [1, 1, 1, 3 if family == "log_reg" else 2]
        assert len(found.model.stages) == stages[-1]


def test_stream_models_are_fitted_on_different_lines(spark, monkeypatch):
    """The models of the stream queries look at segments alone, of which there are few."""
    sizes = []
    monkeypatch.setattr(workload, "fit", lambda pipeline, rows: sizes.append(rows.count()) or fit(pipeline, rows))
    lines = prepare(workload.raw_lines(spark, "/root/testdata/sf0.001").drop("order"), workload.LINES)
    model = workload.segment_regression(lines, workload.PLAIN_LOGIT)
    assert 2 <= sizes[0] <= 12
    whole = build_pipeline("log_reg", workload.SEGMENT_FEATURES, "label", **workload.PLAIN_LOGIT).fit(lines)
    both = [{r.segment: r.p for r in m.transform(lines.withColumn("segment", F.array(*workload.SEGMENT_FEATURES)))
             .select(F.col("segment").cast("string"), vector_item(F.col("probability")).alias("p")).collect()} for m in (model, whole)]
    assert both[0] == pytest.approx(both[1], abs=1e-5)


def test_search_all_tries_every_setting_on_all_rows(spark, monkeypatch):
    asked = {}

    def record(train, test, features, label, families, **options):
        asked.update(dict.fromkeys(families, options))
        return []

    monkeypatch.setattr(workload, "search_families", record)
    assert workload.search_all(spark, "/root/testdata/sf0.001").count() == 0
    assert set(asked) == set(SPACES)
    for options in asked.values():
        assert options["trials"] == 40 and options["rungs"] == (1.0,) and options.get("spaces") in (None, SPACES)


def test_a_scaler_of_counts_is_that_of_the_rows(repeated):
    plain = repeated.withColumnRenamed("b.b", "b")
    pipeline = build_pipeline("log_reg", ["a", "b", "c"], "y", regParam=0.1)
    whole, counted = (model.stages[1] for model in (pipeline.fit(plain), fit(pipeline, fold(plain, ["a", "b", "c", "y"]))))
    assert list(counted.std) == pytest.approx(list(whole.std), rel=1e-12)
    assert list(counted.mean) == pytest.approx(list(whole.mean), rel=1e-12)


def test_comparison_counts_equal_rows(repeated):
    plain = repeated.withColumnRenamed("b.b", "b")
    models = fit_models(plain, {"svm": ("svm", FEW["svm"]), "rf": ("rf", {"numTrees": 3, "seed": 1})}, ["a", "b", "c"], "y")
    found = {(r.model, r.metric): r.value for r in evaluate_models(models, plain, "y").collect()}
    for name, model in models.items():
        scored = model.transform(plain)
        for metric, value in map(tuple, class_metrics(scored, "y").collect()):
            assert found[name, metric] == pytest.approx(value, abs=1e-12)
        assert found[name, "roc_auc"] == pytest.approx(area_under_roc(scored, "y"), abs=1e-12)


def test_search_reads_equal_rows_once(repeated, monkeypatch):
    """With many equal rows each trial is fitted on the different ones; the figures are those of all rows."""
    plain = repeated.withColumnRenamed("b.b", "b").withColumn("k", F.monotonically_increasing_id())
    args = (plain, plain, "log_reg", ["a", "b", "c"], "y", {"regParam": Uniform(0.0, 0.3)})
    options = {"trials": 4, "rungs": (0.5, 1.0), "keys": ["k"], "seed": 2}
    sizes = []
    monkeypatch.setattr(tune, "fit", lambda pipeline, rows, params=None: sizes.append(rows.count()) or fit(pipeline, rows, params))
    counted = search(*args, **options)
    assert max(sizes) <= 12 * 4
    monkeypatch.setattr(tune, "fold", lambda rows, columns: None)
    whole = search(*args, **options)
    assert (counted.rungs, counted.chosen, counted.reached) == (whole.rungs, whole.chosen, whole.reached)
    assert [v for _, v in counted.trials] == pytest.approx([v for _, v in whole.trials])
    assert counted.test == pytest.approx(whole.test)
