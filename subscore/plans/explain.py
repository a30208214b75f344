"""Shapley attributions of model scores, by random walks; those of trees are in ``trees``.

A feature's attribution is its average effect on the score when features are
switched one by one, in a random order, from a background row's values to the
explained row's. Every background row has orders of its own, each walked forwards
and in reverse: the effects of a row still add up exactly, and are exact where
features act alone or in pairs. Only features in which the two rows differ can
change the score, so a walk steps over those alone; with one-hot columns that is
usually a minority.

A walk's points are generated from its own row: nothing is joined, the scored
rows are never held together, all models score the same points, and the effects
are summed before the shuffle. Those of regressions and SVMs are not even generated (``linear``).
"""

from __future__ import annotations

import json
import math
import random
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, Window, functions as F

from subscore.functions import quoted, sigmoid, vector_item
from subscore.operators.small import attach, settle
from subscore.plans.linear import Linear, linear_model, linear_sums
from subscore.plans.trees import Background, is_boosted, is_forest, tree_attributions

Scorer = Callable[[DataFrame], DataFrame]

#: Up to so many features get an expression each. That is compiled as a whole and much faster than
#: arrays; with more of them, methods become too long for the JVM to optimise.
NARROW = 12


def sample_background(
    df: DataFrame, features: Sequence[str], key: Sequence[str], n: int, seed: int = 0
) -> Background:
    """``n`` rows drawn evenly from all of ``df``: those whose key has the smallest hash.

    The draw does not depend on order or partitioning, and other engines can repeat it:
    ``ORDER BY md5(seed | key...), key... LIMIT n``. The ``n`` rows become a constant of every
    plan that uses them, and each explained row is walked to from all of them.
    """
    keys = [F.col(quoted(name)) for name in key]
    text = F.concat_ws("|", F.lit(str(seed)), *[k.cast("string") for k in keys])
    numbers = [F.col(quoted(name)).cast("double") for name in features]
    rows = df.orderBy(F.md5(text), *keys).limit(n).select(F.array(*numbers)).collect()
    return Background(list(features), [list(row[0]) for row in rows])


def class_probability(scored: DataFrame) -> Column:
    """Probability of class 1; sigmoid of the margin where a model has no probability."""
    if "probability" in scored.columns:
        return vector_item(F.col("probability"))
    return sigmoid(vector_item(F.col("rawPrediction")))


def probability_scorer(model: PipelineModel) -> Scorer:
    """The model as a function that adds a ``score`` column to a table of features."""

    def add_score(df: DataFrame) -> DataFrame:
        scored = model.transform(df)
        return scored.withColumn("score", class_probability(scored)).select(*map(quoted, df.columns), "score")

    add_score.linear = linear_model(model)
    return add_score


def explained_scorer(model: PipelineModel, boosted: str = "margin") -> Scorer:
    """What :func:`explain_models` explains: the probability of class 1, of boosted trees what it is told."""
    if not (is_boosted(model) and boosted == "margin"):
        return probability_scorer(model)

    def add_score(df: DataFrame) -> DataFrame:
        scored = model.transform(df).withColumn("score", vector_item(F.col("rawPrediction")))
        return scored.select(*map(quoted, df.columns), "score")

    return add_score


def _literal(value: list, schema: str) -> Column:
    """A nested list as a constant, folded once when the plan is optimised."""
    return F.from_json(F.lit(json.dumps(value)), schema)


def _walks(base: list[list[float]], features: int, orders: int, seed: int) -> list[dict]:
    """For each background row, ``orders`` random orders of the features and their reverses."""
    rng = random.Random(seed)
    walks = []
    for row in base:
        for _ in range(orders):
            order = rng.sample(range(features), features)
            for path in (order, order[::-1]):
                place = [0] * features
                for position, feature in enumerate(path):
                    place[feature] = position
                walks.append({"base": row, "path": path, "place": place})
    return walks


def _numbered(rows: DataFrame, features: Sequence[str], key: Sequence[str]) -> DataFrame:
    """(_key0..., _own): the keys under names that clash with nothing, the features as an array."""
    return rows.select(
        *[F.col(quoted(name)).alias(f"_key{i}") for i, name in enumerate(key)],
        F.array(*[F.col(quoted(name)).cast("double") for name in features]).alias("_own"),
    )


def _scored_points(
    numbered: DataFrame,
    features: Sequence[str],
    keys: Sequence[str],
    walks: list[dict],
    scorers: Mapping[str, Scorer],
    kept: Sequence[str] = (),
) -> DataFrame:
    """(keys, kept..., _gained, _lost, scores): all points of the walks of each row, scored.

    ``_gained`` is the feature that the step to a point switched, ``_lost`` that of the next
    step. ``kept`` are numbers of a walk to keep with its points.
    """
    if len(features) <= NARROW:
        points = _narrow_points(numbered, features, keys, walks, kept)
        return _scored(points.drop("_own"), scorers)
    more = "".join(f",{name}:int" for name in kept)
    walk = f"array<struct<base:array<double>,path:array<int>,place:array<int>{more}>>"
    steps = numbered.withColumn("_walk", F.explode(_literal(walks, walk))).withColumn(
        "_steps", F.filter("_walk.path", lambda i: F.get("_own", i) != F.get("_walk.base", i))
    )
    size = F.size("_steps")
    points = steps.withColumn("_at", F.explode(F.when(size > 0, F.sequence(F.lit(0), size))))
    gained, lost = F.get("_steps", F.col("_at") - 1), F.get("_steps", F.col("_at"))
    reached = F.coalesce(F.get("_walk.place", gained), F.lit(-1))
    own = [*keys, *kept]
    points = points.select(
        *keys, *[F.col(f"_walk.{name}").alias(name) for name in kept], "_own",
        F.col("_walk.base").alias("_base"), F.col("_walk.place").alias("_place"),
        gained.alias("_gained"), lost.alias("_lost"), reached.alias("_reached"),
    )
    # Mixed as an array: one expression per feature would compile to a method too long
    # for the JVM to optimise.
    switched = F.transform(
        "_place",
        lambda place, i: F.when(place <= F.col("_reached"), F.get("_own", i)).otherwise(
            F.get("_base", i)
        ),
    )
    scored = points.select(*own, "_gained", "_lost", switched.alias("_mixed")).select(
        *own,
        "_gained",
        "_lost",
        *[F.get("_mixed", F.lit(i)).alias(name) for i, name in enumerate(features)],
    )
    return _scored(scored, scorers)


def _scored(points: DataFrame, scorers: Mapping[str, Scorer]) -> DataFrame:
    for made, scorer in scorers.items():
        before = points.columns
        points = scorer(points).select(*map(quoted, before), F.col("score").alias(made))
    return points


def _narrow_points(
    numbered: DataFrame,
    features: Sequence[str],
    keys: Sequence[str],
    walks: list[dict],
    kept: Sequence[str] = (),
    marked: bool = False,
) -> DataFrame:
    """(keys, kept..., _own, _gained, _lost, features...): the points of :func:`_scored_points`, not yet scored.

    Which places of a walk switch a feature are the bits of a number. With ``marked``, each row
    first has a point of its own that neither gains nor loses a feature.
    """
    n = len(features)
    more = "".join(f",{name}:int" for name in kept)
    walk = f"array<struct<base:array<double>,path:array<int>,place:array<int>,first:int{more}>>"
    listed = [entry | {"first": int(at == 0)} for at, entry in enumerate(walks)]
    steps = numbered.select(*keys, "_own", F.explode(_literal(listed, walk)).alias("_walk"))
    own = [F.get("_own", F.lit(i)) for i in range(n)]
    base, place = ([F.get(f"_walk.{name}", F.lit(i)) for i in range(n)] for name in ("base", "place"))
    bits = F.lit(0)
    for i in range(n):
        bits = bits + F.when(own[i] != base[i], F.call_function("shiftleft", F.lit(1), place[i])).otherwise(0)
    steps = steps.select(*keys, "_own", "_walk", bits.alias("_bits"))
    at, switched = F.col("_at"), F.col("_bits")
    here = (at > 0) & (F.call_function("shiftright", switched, at - 1).bitwiseAND(1) == 1)
    wanted = (switched != 0) & ((at == 0) | here)
    if marked:
        wanted = wanted | ((at == -1) & (F.col("_walk.first") == 1))
    places = F.array(*[F.lit(i) for i in range(-1 if marked else 0, n + 1)])
    points = steps.withColumn("_at", F.explode(places)).where(wanted)
    rest = F.when(at >= 0, F.call_function("shiftright", switched, at)).otherwise(0)
    # The lowest bit that is left is the next step.
    following = at + F.bit_count(rest.bitwiseAND(-rest) - 1)
    return points.select(
        *keys, *[F.col(f"_walk.{name}").alias(name) for name in kept], "_own",
        F.when(at > 0, F.get("_walk.path", at - 1)).alias("_gained"),
        F.when(rest != 0, F.get("_walk.path", following)).alias("_lost"),
        *[F.when(place[i] < at, own[i]).otherwise(base[i]).alias(name) for i, name in enumerate(features)],
    )


def _narrow_sums(
    numbered: DataFrame,
    features: Sequence[str],
    keys: Sequence[str],
    walks: list[dict],
    scorers: Mapping[str, Scorer],
) -> DataFrame:
    """(keys, _feature, value, _rows, scores): the summed effects of each row, which is read once and sent once."""
    points = _narrow_points(numbered, features, keys, walks, marked=True)
    own = [F.get("_own", F.lit(i)).alias(f"_own{i}") for i in range(len(features))]
    mark = F.col("_gained").isNull() & F.col("_lost").isNull()
    points = points.select(*keys, *own, mark.cast("int").alias("_mark"), "_gained", "_lost", *map(quoted, features))
    weight = 1.0 / len(walks)
    sums = [F.sum("_mark").alias("_rows")]
    for i in range(len(features)):
        sign = F.when(F.col("_gained") == i, weight).when(F.col("_lost") == i, -weight).otherwise(0.0)
        sums.append(F.max(F.when(F.col("_mark") == 1, F.col(f"_own{i}"))).alias(f"_own{i}"))
        # A score that is missing matters only to the features it belongs to.
        sums += [F.sum(F.when(sign != 0, F.col(made) * sign).otherwise(0.0)).alias(f"{made}_{i}") for made in scorers]
    each = [
        F.struct(
            F.lit(i).alias("_feature"), F.col(f"_own{i}").alias("value"), *[F.col(f"{made}_{i}").alias(made) for made in scorers]
        )
        for i in range(len(features))
    ]
    return _scored(points, scorers).groupBy(*keys).agg(*sums).select(*keys, "_rows", F.inline(F.array(*each)))


def _wide_sums(
    numbered: DataFrame,
    features: Sequence[str],
    keys: Sequence[str],
    walks: list[dict],
    scorers: Mapping[str, Scorer],
) -> DataFrame:
    """As :func:`_narrow_sums`, for any number of features: a row for each effect."""
    sums, weight, nothing = list(scorers), 1.0 / len(walks), F.lit(None).cast("double")

    def effect(feature: str, sign: float) -> Column:
        return F.struct(
            F.col(feature).alias("_feature"),
            nothing.alias("value"),
            F.lit(0).alias("_rows"),
            *[(F.col(made) * (sign * weight)).alias(made) for made in sums],
        )

    effects = (
        _scored_points(numbered, features, keys, walks, scorers)
        .select(*keys, F.inline(F.array(effect("_gained", 1.0), effect("_lost", -1.0))))
        .where(F.col("_feature").isNotNull())
    )
    # Every feature of every row appears, also those that no walk changes.
    own_values = numbered.select(
        *keys,
        F.posexplode("_own").alias("_feature", "value"),
        F.lit(1).alias("_rows"),
        *[F.lit(0.0).alias(made) for made in sums],
    )
    return (
        effects.unionByName(own_values)
        .groupBy(*keys, "_feature")
        .agg(
            F.max("value").alias("value"),
            F.sum("_rows").alias("_rows"),
            *[F.sum(made).alias(made) for made in sums],
        )
    )


def _linear(scorer: Scorer, background: Background) -> Linear | None:
    """The weights of a scorer that has some, if the background has a number for each of its features."""
    linear = getattr(scorer, "linear", None)
    whole = all(x is not None and not math.isnan(x) for row in background.rows for x in row)
    return linear if linear is not None and whole and {*linear.names} <= {*background.features} else None


def attributions(
    rows: DataFrame,
    background: Background,
    key: Sequence[str],
    scorers: Scorer | Mapping[str, Scorer],
    orders: int = 1,
    seed: int = 0,
    partitions: int | None = None,
) -> DataFrame:
    """(model,) key..., feature, value, attribution for every row, feature and scorer.

    ``scorers`` is a function that adds a ``score`` column, or several by name; all of them
    score the same points. If all are regressions or SVMs, the points are not made (``linear``). The attributions of a row add up to its score less the
    background's mean score. A key that comes twice fails. ``partitions`` spreads a short
    table of rows, which otherwise stays in the few tasks it comes from.
    """
    features, key = background.features, list(key)
    if not background.rows:
        raise ValueError("the background has no rows")
    named = scorers if isinstance(scorers, Mapping) else {"": scorers}
    walks = _walks(background.rows, len(features), orders, seed)
    keys = [f"_key{i}" for i in range(len(key))]
    numbered = _numbered(rows, features, key)
    if partitions is not None:
        numbered = numbered.repartition(partitions, *keys)
    sums = [f"_score{i}" for i in range(len(named))]
    sized = dict(zip(sums, named.values(), strict=True))
    linear = {made: _linear(scorer, background) for made, scorer in sized.items()}
    if all(linear.values()):
        summed = linear_sums(numbered, features, keys, walks, linear)
    else:
        narrow = len(features) <= NARROW
        summed = (_narrow_sums if narrow else _wide_sums)(numbered, features, keys, walks, sized)
    twice = F.raise_error(F.lit(f"more than one row has the same {', '.join(key)}")).cast("double")
    names = _literal(features, "array<string>")
    found = summed.select(
        *[F.col(made).alias(name) for made, name in zip(keys, key, strict=True)],
        F.get(names, F.col("_feature")).alias("feature"),
        F.when(F.col("_rows") > 1, twice).otherwise(F.col("value")).alias("value"),
        *sums,
    )
    kept = [*map(quoted, key), "feature", "value"]
    if not isinstance(scorers, Mapping):
        return found.select(*kept, F.col(sums[0]).alias("attribution"))
    each = F.inline(
        F.array(
            *[
                F.struct(F.lit(name).alias("model"), F.col(made).alias("attribution"))
                for name, made in zip(named, sums, strict=True)
            ]
        )
    )
    return found.select(*kept, each).select("model", *kept, "attribution")


def attributions_within(
    rows: DataFrame,
    background: Background,
    key: Sequence[str],
    scorer: Scorer,
    tolerance: float,
    orders: int = 4,
    rounds: int = 6,
    seed: int = 0,
) -> DataFrame:
    """key..., feature, value, attribution, error: sampled until the error is small enough.

    An order and its reverse give one estimate of each effect, and every background row has
    ``orders`` of them at first. ``error`` is the standard error of the attribution: from the
    variance of the estimates about their mean, background row by background row, as the rows
    themselves are all met alike. Rows with an error above ``tolerance`` in any feature are walked again, each
    time twice as often as before and by new orders, for ``rounds`` rounds at most; counts, means
    and squares of all rounds are merged. What has reached the tolerance is scored no more.

    The error is itself an estimate: where the orders drawn happen to agree, few of them can state
    too small a one, so ``orders`` should grow with the number of features that act together.

    Each round sends the rows that are still open once, before they are walked; points stay in
    their task. Orders that are drawn more than once are walked once and counted.
    A key that comes twice counts as one row walked twice as often.
    """
    features, key = background.features, list(key)
    if not background.rows:
        raise ValueError("the background has no rows")
    if orders < 2:
        raise ValueError(f"an error takes two orders or more, got {orders}")
    keys = [f"_key{i}" for i in range(len(key))]
    numbered = _numbered(rows, features, key)
    own = settle(numbered.select(*keys, F.posexplode("_own").alias("_feature", "value")))
    todo, known, final = numbered, None, []
    for number in range(rounds):
        walks = []
        for base, row in enumerate(background.rows):
            drawn = _walks([row], len(features), orders << number, hash((seed, number, base)) & 0x7FFFFFFF)
            walks += _different_pairs(drawn, base)
        # Dealt by the key before anything is walked: rows are sent, their points never are.
        dealt = todo.repartition(*keys)
        scored = _scored_points(dealt, features, keys, walks, {"_score": scorer}, ["_background", "_pair", "_drawn"])
        effect = lambda feature, sign: F.struct(
            F.col(feature).alias("_feature"), (F.col("_score") * (sign / 2)).alias("_effect")
        )
        parts = scored.select(
            *keys, "_background", "_pair", "_drawn", F.inline(F.array(effect("_gained", 1.0), effect("_lost", -1.0)))
        ).where("_feature IS NOT NULL")
        estimates = parts.groupBy(*keys, "_feature", "_background", "_pair").agg(
            F.max("_drawn").cast("long").alias("_n"), F.sum("_effect").alias("_mean"), F.lit(0.0).alias("_m2")
        )
        by = [*keys, "_feature", "_background"]
        found = _pooled(estimates.drop("_pair"), by)
        known = settle(found if known is None else _pooled(known.unionByName(found), by))
        share = 1.0 / len(background.rows)
        errors = settle(
            known.groupBy(*keys, "_feature").agg(
                (F.sum("_mean") * share).alias("attribution"),
                (F.sqrt(F.sum(F.col("_m2") / (F.col("_n") * (F.col("_n") - 1)))) * share).alias("error"),
            )
        )
        if number + 1 < rounds:
            open_rows = settle(errors.where(F.col("error") > tolerance).select(*keys).distinct())
            if not open_rows.isEmpty():
                # What is known of the others is final; it is neither read nor merged again.
                final.append(attach(errors, open_rows, keys, "left_anti"))
                todo, known = attach(numbered, open_rows, keys), attach(known, open_rows, keys)
                continue
        final.append(errors)
        break
    errors = final[0]
    for more in final[1:]:
        errors = errors.unionByName(more)
    names = _literal(features, "array<string>")
    # A feature that no background row differs in has no effect, without any error.
    joined = attach(own, errors if len(final) == 1 else settle(errors), [*keys, "_feature"], "left")
    return joined.select(
        *[F.col(made).alias(name) for made, name in zip(keys, key, strict=True)],
        F.get(names, F.col("_feature")).alias("feature"),
        "value",
        F.coalesce("attribution", F.lit(0.0)).alias("attribution"),
        F.coalesce("error", F.lit(0.0)).alias("error"),
    )


def _different_pairs(walks: list[dict], background: int) -> list[dict]:
    """Each different order once with its reverse, ``_drawn`` telling how often the two were drawn.

    An order and its reverse give the same estimate whichever comes first and however often, so few
    features need few walks, whatever the number of orders.
    """
    pairs: dict[tuple, list[dict]] = {}
    for forth, back in zip(walks[::2], walks[1::2], strict=True):
        pairs.setdefault(min(tuple(forth["path"]), tuple(back["path"])), []).append((forth, back))
    return [
        walk | {"_background": background, "_pair": number, "_drawn": len(drawn)}
        for number, drawn in enumerate(pairs.values())
        for walk in drawn[0]
    ]


def _pooled(parts: DataFrame, by: list[str]) -> DataFrame:
    """Counts, means and squared distances of several samples as those of all of them together."""
    n, mean = F.sum("_n"), F.sum(F.col("_n") * F.col("_mean")) / F.sum("_n")
    listed = F.collect_list(F.struct("_n", "_mean", "_m2"))
    merged = parts.groupBy(*by).agg(n.alias("_all"), mean.alias("_middle"), listed.alias("_parts"))
    distance = F.aggregate(
        "_parts",
        F.lit(0.0),
        lambda total, part: total
        + part["_m2"]
        + part["_n"] * (part["_mean"] - F.col("_middle")) * (part["_mean"] - F.col("_middle")),
    )
    return merged.select(*by, F.col("_all").alias("_n"), F.col("_middle").alias("_mean"), distance.alias("_m2"))


def explain_model(
    model: PipelineModel,
    data: DataFrame,
    background: Background,
    key: Sequence[str],
    n_samples: int | None = None,
    **options,
) -> DataFrame:
    """Attributions of one model, as by :func:`explain_models`, without the ``model`` column."""
    return explain_models({"": model}, data, background, key, n_samples, **options).drop("model")


def explain_models(
    models: Mapping[str, PipelineModel],
    data: DataFrame,
    background: Background,
    key: Sequence[str],
    n_samples: int | None = None,
    boosted: str = "probability",
    **options,
) -> DataFrame:
    """Attributions of each model's probability of class 1 for all rows, or the first ``n_samples`` by key.

    Forests are explained exactly by the paths to their leaves, in one narrow pass. All other
    models go along the same random walks (``options`` of :func:`attributions`). Boosted
    trees add up to a margin, not to a probability: with ``boosted="margin"`` that is explained
    instead, exactly and by their leaves as well.
    """
    if boosted not in ("probability", "margin"):
        raise ValueError(f"boosted trees have a probability and a margin, not {boosted!r}")
    data = _first(data, key, n_samples)
    exact = {
        name: model
        for name, model in models.items()
        if is_forest(model) or (boosted == "margin" and is_boosted(model))
    }
    walked = {name: probability_scorer(model) for name, model in models.items() if name not in exact}
    found = []
    if exact:
        found.append(tree_attributions(data, background, key, exact))
    # Regressions and SVMs go along the walks by themselves, and need no points.
    for linear in (True, False):
        some = {name: scorer for name, scorer in walked.items() if (_linear(scorer, background) is not None) == linear}
        if some:
            found.append(attributions(data, background, key, some, **options))
    return reduce(DataFrame.unionByName, found)


def _first(data: DataFrame, key: Sequence[str], n: int | None) -> DataFrame:
    return data if n is None else data.orderBy(*[F.col(quoted(name)) for name in key]).limit(n)


def importance(attributed: DataFrame, top: int = 10, by: Sequence[str] = ()) -> DataFrame:
    """(by..., feature, importance): mean absolute attribution, the ``top`` largest first.

    With ``by`` (say the model), the ``top`` largest of each group.
    """
    means = attributed.groupBy(*by, "feature").agg(
        F.avg(F.abs("attribution")).alias("importance")
    )
    largest = [F.desc("importance"), F.asc("feature")]
    if not by:
        return means.orderBy(*largest).limit(top)
    # One row per feature by now, so a window holds no more rows than the table has columns.
    place = F.row_number().over(Window.partitionBy(*by).orderBy(*largest))
    return means.withColumn("_place", place).where(F.col("_place") <= top).drop("_place")
