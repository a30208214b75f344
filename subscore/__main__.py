"""Command line: work on the subscriber table.

    python -m subscore profile --input raw.csv
    python -m subscore split --input raw.csv --train train.csv --test test.csv --ratio 0.8
    python -m subscore train --train train.csv --test test.csv --models out \\
        [--ratio 0.8 --metric f1 --smaller-is-better]
    python -m subscore score --model out/rf --input new.csv --output scores
    python -m subscore rejects --input new.csv --output dropped
    python -m subscore events --model out/rf --input event.json --output scores
    python -m subscore stream --model out/rf --format FORMAT --option name=value \\
        --output scores --checkpoint state [--once] [--batches]
    python -m subscore evaluate --models out --input test.csv
    python -m subscore explain --models out --input test.csv --background 20 --samples 100

Connector jars and storage credentials are given to ``spark-submit`` as usual.
"""

from __future__ import annotations

import argparse

from subscore.operators.profile import column_summary, null_counts, value_shares
from subscore.operators.quantiles import medians
from subscore.operators.split import split_by_key
from subscore.plans.evaluate import evaluate_models
from subscore.plans.explain import explain_models, importance, sample_background
from subscore.plans.prepare import clean, prepare, rejects
from subscore.plans.score import score, score_events
from subscore.plans.subscribers import COLUMNS, SUBSCRIBERS
from subscore.plans.train import train
from subscore.plans.tune import RUNGS, selections_frame
from subscore.session import build_session
from subscore.sources.messages import event_records, message_stream
from subscore.sources.tables import load_model, read_csv, write_csv, write_scores
from subscore.streaming import start_batch_scoring, start_scoring

FAMILY_NAMES = ["rf", "log_reg", "gbdt", "svm"]


def parse(arguments: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="subscore")
    commands = parser.add_subparsers(dest="command", required=True)

    command = commands.add_parser("profile")
    command.add_argument("--input", required=True)

    command = commands.add_parser("split")
    command.add_argument("--input", required=True)
    command.add_argument("--train", required=True)
    command.add_argument("--test", required=True)
    command.add_argument("--ratio", type=float, default=0.8)
    command.add_argument("--seed", type=int, default=0)

    command = commands.add_parser("rejects")
    command.add_argument("--input", required=True)
    command.add_argument("--output", required=True)

    command = commands.add_parser("train")
    command.add_argument("--train", required=True)
    command.add_argument("--test", required=True)
    command.add_argument("--models", required=True)
    command.add_argument("--families", nargs="+", default=FAMILY_NAMES)
    command.add_argument("--trials", type=int, default=40)
    command.add_argument("--ratio", type=float, default=0.8)
    command.add_argument("--metric", default="f1")
    command.add_argument("--smaller-is-better", action="store_true")
    command.add_argument("--seed", type=int, default=0)
    command.add_argument("--halving", action="store_true", help="fit all settings on few rows, the best on all")

    for name in ("score", "events", "stream"):
        command = commands.add_parser(name)
        command.add_argument("--model", required=True)
        command.add_argument("--output", required=True)
        if name != "stream":
            command.add_argument("--input", required=True)
            continue
        command.add_argument("--checkpoint", required=True)
        command.add_argument("--format", required=True)
        command.add_argument("--option", action="append", default=[], metavar="NAME=VALUE")
        command.add_argument("--path")
        command.add_argument("--schema")
        command.add_argument("--once", action="store_true")
        command.add_argument("--batches", action="store_true", help="one folder per micro-batch")
        command.add_argument("--every", help="trigger interval, such as '10 seconds'")

    for name in ("evaluate", "explain"):
        command = commands.add_parser(name)
        command.add_argument("--models", required=True)
        command.add_argument("--families", nargs="+", default=FAMILY_NAMES)
        command.add_argument("--input", required=True)
        if name == "explain":
            command.add_argument("--background", type=int, required=True, metavar="ROWS")
            command.add_argument("--samples", type=int)
            command.add_argument("--top", type=int, default=10)
    return parser.parse_args(arguments)


def main(arguments: list[str] | None = None) -> None:
    given = parse(arguments)
    spark = build_session()
    labelled = [*COLUMNS, SUBSCRIBERS.label]
    if given.command == "profile":
        raw = read_csv(spark, given.input)
        column_summary(raw).show(100, False)
        typed = clean(raw, SUBSCRIBERS)
        null_counts(typed).show(100, False)
        medians(typed, SUBSCRIBERS.types).show()
        if SUBSCRIBERS.label in raw.columns:
            value_shares(raw, SUBSCRIBERS.label).show()
    elif given.command == "split":
        raw = read_csv(spark, given.input)
        parts = split_by_key(raw, [SUBSCRIBERS.key], given.ratio, given.seed)
        for part, path in zip(parts, (given.train, given.test), strict=True):
            write_csv(part, path)
    elif given.command == "rejects":
        write_csv(rejects(read_csv(spark, given.input), SUBSCRIBERS), given.output)
    elif given.command == "train":
        selections = train(
            read_csv(spark, given.train),
            read_csv(spark, given.test),
            SUBSCRIBERS,
            families=given.families,
            trials=given.trials,
            ratio=given.ratio,
            metric=given.metric,
            greater_is_better=False if given.smaller_is_better else None,
            seed=given.seed,
            save_to=given.models,
            rungs=RUNGS if given.halving else (1.0,),
        )
        selections_frame(spark, selections).show(truncate=False)
    elif given.command == "score":
        raw = read_csv(spark, given.input).select(*COLUMNS)
        write_scores(score(raw, load_model(given.model), SUBSCRIBERS), given.output)
    elif given.command == "events":
        events = event_records(spark, given.input)
        score_events(events, COLUMNS, load_model(given.model), SUBSCRIBERS, given.output)
    elif given.command == "stream":
        options = dict(option.split("=", 1) for option in given.option)
        messages = message_stream(spark, given.format, options, given.schema, given.path)
        start = start_batch_scoring if given.batches else start_scoring
        start(
            messages,
            COLUMNS,
            load_model(given.model),
            SUBSCRIBERS,
            given.output,
            given.checkpoint,
            once=given.once,
            every=given.every,
        ).awaitTermination()
    else:
        rows = prepare(read_csv(spark, given.input).select(*labelled), SUBSCRIBERS)
        models = {name: load_model(f"{given.models}/{name}") for name in given.families}
        if given.command == "evaluate":
            evaluate_models(models, rows, SUBSCRIBERS.label).orderBy("metric", "model").show()
        else:
            key = [SUBSCRIBERS.key]
            background = sample_background(rows, SUBSCRIBERS.features, key, given.background)
            found = explain_models(models, rows, background, key, n_samples=given.samples)
            importance(found, given.top, by=["model"]).show(given.top * len(models), False)


if __name__ == "__main__":
    main()
