from __future__ import annotations

import base64
import json
import random
import tempfile

import pytest

from subscore.__main__ import main, parse
from subscore.plans.models import build_pipeline
from subscore.plans.prepare import prepare
from subscore.plans.score import score, score_events
from subscore.plans.subscribers import COLUMNS, SUBSCRIBERS
from subscore.sources.messages import event_records, message_stream
from subscore.sources.tables import read_csv, read_typed_csv, save_model, write_csv
from subscore.streaming import start_batch_scoring, start_scoring
from subscore.streaming.scoring import _holds_messages
from tests.conftest import subscriber


@pytest.fixture(scope="module")
def model(subscribers):
    rows = prepare(subscribers, SUBSCRIBERS)
    return build_pipeline("log_reg", SUBSCRIBERS.features, "Churn", regParam=0.01).fit(rows)


@pytest.fixture(scope="module")
def mixed():
    """Messages with faults between good rows, and the keys that must be scored."""
    rng = random.Random(9)
    rows = [subscriber(number, rng) for number in range(40)]
    for row in rows:
        del row["Churn"]
    rows[3]["TotalCharges"] = " "
    rows[10]["gender"] = "?"
    rows[20]["customerID"] = None
    del rows[25]["Contract"]
    rows[30]["customerID"] = "Zoë"
    texts = [json.dumps(row, ensure_ascii=False) for row in rows]
    texts.insert(5, "no json")
    texts.insert(6, "")
    good = [row["customerID"] for i, row in enumerate(rows) if i not in (3, 10, 20, 25)]
    return rows, texts, sorted(good)


@pytest.fixture(scope="module")
def expected(spark, mixed, model):
    """Each good row scored by itself."""
    rows, _, good = mixed
    names = [row for row in rows if row.get("customerID") in good and "Contract" in row]
    raw = spark.createDataFrame([tuple(r[c] for c in COLUMNS) for r in names], ", ".join(f"{c} string" for c in COLUMNS))
    return dict(map(tuple, score(raw, model, SUBSCRIBERS).collect()))


def test_dirty_rows_shift_no_key(mixed, expected):
    assert sorted(expected) == mixed[2]
    assert len(set(expected.values())) == 2


def written(spark, path) -> list[tuple]:
    return sorted(map(tuple, spark.read.json(path).select("customerID", "prediction").collect()))


def test_event_batch(spark, mixed, model, expected, tmp_path):
    encoded = [base64.b64encode(text.encode()).decode() for text in mixed[1]]
    event = {"Records": [{"kinesis": {"data": text}} for text in [*encoded, json.dumps(encoded[0])]]}
    (tmp_path / "event.json").write_text(json.dumps(event))
    events = event_records(spark, str(tmp_path / "event.json"))
    assert events.count() == len(mixed[1]) + 1
    score_events(events, COLUMNS, model, SUBSCRIBERS, str(tmp_path / "out"))
    again = [("C00000", expected["C00000"])]
    assert written(spark, str(tmp_path / "out")) == sorted([*expected.items(), *again])


def test_empty_event_batch_writes_nothing(spark, model, tmp_path):
    events = spark.createDataFrame([], "data string")
    score_events(events, COLUMNS, model, SUBSCRIBERS, str(tmp_path / "out"))
    assert not (tmp_path / "out").exists()


@pytest.mark.parametrize("start", [start_scoring, start_batch_scoring])
def test_stream_equals_batch_and_restarts_without_repeats(spark, mixed, model, expected, tmp_path, start):
    incoming, out, state = (tmp_path / name for name in ("in", "out", "state"))
    incoming.mkdir()
    half = len(mixed[1]) // 2

    def run():
        messages = message_stream(spark, "text", {"maxFilesPerTrigger": "1"}, path=str(incoming))
        start(
            messages, COLUMNS, model, SUBSCRIBERS, str(out), str(state), once=True, payload="value"
        ).awaitTermination()

    (incoming / "1.txt").write_text("\n".join(mixed[1][:half]))
    run()
    first = written(spark, str(out))
    run()
    assert written(spark, str(out)) == first
    (incoming / "2.txt").write_text("\n".join(mixed[1][half:]))
    (incoming / "3.txt").write_text("")
    run()
    assert written(spark, str(out)) == sorted(expected.items())
    if start is start_batch_scoring:
        assert sorted(path.name for path in out.iterdir()) == ["batch_id=0", "batch_id=1"]


def test_continuous_stream(spark, mixed, model, expected, tmp_path):
    incoming = tmp_path / "in"
    incoming.mkdir()
    (incoming / "1.txt").write_text("\n".join(mixed[1]))
    query = start_scoring(
        message_stream(spark, "text", {}, path=str(incoming)),
        COLUMNS,
        model,
        SUBSCRIBERS,
        str(tmp_path / "out"),
        str(tmp_path / "state"),
        every="100 milliseconds",
        payload="value",
    )
    try:
        query.processAllAvailable()
        assert query.isActive
    finally:
        query.stop()
    assert written(spark, str(tmp_path / "out")) == sorted(expected.items())


def test_a_batch_is_not_read_to_see_whether_it_is_empty(spark, tmp_path):
    place = str(tmp_path)

    def seen(batches):
        tempfile.mkstemp(dir=place)
        yield from batches

    parts = spark.range(0, 80, 1, 8).mapInArrow(seen, "id long")
    assert _holds_messages(parts) and len(list(tmp_path.iterdir())) == 1
    assert not _holds_messages(parts.where("id < 0"))


def test_csv_round_trip(spark, tmp_path):
    rows = [(" 1", "a,b", '"q"'), ("2 ", " ", None), ("3", "x\\y", "ü")]
    df = spark.createDataFrame(rows, "a string, b string, c string")
    path = str(tmp_path / "csv")
    write_csv(df.coalesce(1), path)
    assert sorted(map(tuple, read_csv(spark, path, df.columns).collect())) == sorted(rows)
    assert read_csv(spark, path).schema == read_csv(spark, path, df.columns).schema
    write_csv(spark.range(3).selectExpr("id", "id / 2 AS half"), path)
    assert read_typed_csv(spark, path).dtypes == [("id", "int"), ("half", "double")]
    assert read_typed_csv(spark, path, "id long, half double").dtypes[0] == ("id", "bigint")


def test_command_line(spark, subscribers, model, tmp_path, capsys):
    data, out = str(tmp_path / "data"), str(tmp_path / "out")
    write_csv(subscribers, data)
    save_model(model, str(tmp_path / "models/log_reg"))
    main(["score", "--model", str(tmp_path / "models/log_reg"), "--input", data, "--output", out])
    assert len(written(spark, out)) == subscribers.count()
    shared = ["--models", str(tmp_path / "models"), "--families", "log_reg", "--input", data]
    main(["evaluate", *shared])
    assert "roc_auc" in capsys.readouterr().out
    main(["explain", *shared, "--background", "3", "--samples", "3", "--top", "4"])
    assert "importance" in capsys.readouterr().out
    main(["profile", "--input", data])
    assert "median" in capsys.readouterr().out
    parts = [str(tmp_path / name) for name in ("train", "test")]
    main(["split", "--input", data, "--train", parts[0], "--test", parts[1], "--ratio", "0.7"])
    assert sum(read_csv(spark, part).count() for part in parts) == subscribers.count()
    main(["rejects", "--input", data, "--output", str(tmp_path / "dropped")])
    given = parse(["train", "--train", "a", "--test", "b", "--models", "c", "--metric", "hammingLoss", "--smaller-is-better"])
    assert (given.trials, given.ratio, given.smaller_is_better) == (40, 0.8, True)
