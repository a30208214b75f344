"""Start positions, restarts and model versions of streams over a message log."""

from __future__ import annotations

import json

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from subscore.plans.models import build_pipeline
from subscore.plans.prepare import TableSpec
from subscore.sources import message_log
from subscore.sources.message_log import append_messages, end_of, register_message_log, segments
from subscore.sources.messages import message_stream
from subscore.sources.model_store import load_version, newest_version, publish_model, versions
from subscore.streaming import start_versioned_scoring


def append(spark, log, first, last, segment=7):
    rows = [(n, f"m{n}") for n in range(first, last)]
    return append_messages(spark.createDataFrame(rows, "k int, value string").repartition(5), log, ["k"], segment=segment)


def read(spark, log, checkpoint, out, **options):
    stream = message_stream(spark, "message_log", options, path=log)
    running = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
    running.trigger(availableNow=True).start().awaitTermination()
    return sorted(map(tuple, spark.read.schema("offset long, value string").parquet(out).collect()))


def expected(first, last):
    return [(n, f"m{n}") for n in range(first, last)]


def test_messages_are_numbered_without_gaps(spark, tmp_path):
    log = str(tmp_path / "log")
    assert end_of(log) == 0
    assert append(spark, log, 0, 50) == 50 == end_of(log)
    assert append(spark, log, 50, 61) == 61
    found = segments(log)
    assert [(s.first, s.last) for s in found] == [(n, min(n + 7, 50)) for n in range(0, 50, 7)] + [(50, 57), (57, 61)]
    register_message_log(spark)
    rows = spark.read.format("message_log").load(log)
    assert sorted(map(tuple, rows.collect())) == expected(0, 61)
    with pytest.raises(Exception, match="line break"):
        append_messages(spark.createDataFrame([(1, "a\nb")], "k int, value string"), log, ["k"])
    assert end_of(log) == 61 and append(spark, log, 0, 0) == 61


def test_many_segments_are_read_by_few_tasks(spark, tmp_path, monkeypatch):
    """A task for each segment costs more than it reads; a few segments still have a task each."""
    log = str(tmp_path / "log")
    append(spark, log, 0, 61)
    assert [len(run.segments) for run in message_log._Log({"path": log}).between(0, 61)] == [1] * 9
    monkeypatch.setattr(message_log, "PARTS", 3)
    runs = message_log._Log({"path": log}).between(10, 60)
    assert [len(run.segments) for run in runs] == [3, 3, 2]
    assert [(s.first, s.last) for run in runs for s in run.segments] == [(n, min(n + 7, 60)) if n > 7 else (10, 14) for n in range(7, 60, 7)]
    read_back = [x for run in runs for batch in message_log._Log({"path": log}).rows(run) for x in zip(*map(pa.Array.to_pylist, batch.columns))]
    assert read_back == expected(10, 60)


def test_missing_and_empty_messages_are_empty_lines(spark, tmp_path):
    log = str(tmp_path / "log")
    rows = [(0, None), (1, "é"), (2, ""), (3, None), (4, "x" * 70_000)]
    assert append_messages(spark.createDataFrame(rows, "k int, value string"), log, ["k"], segment=3) == 5
    register_message_log(spark)
    assert sorted(map(tuple, spark.read.format("message_log").load(log).collect())) == [(n, text or "") for n, text in rows]


def test_start_positions(spark, tmp_path):
    log = str(tmp_path / "log")
    append(spark, log, 0, 40)
    starts = {"earliest": 0, "13": 13, "latest": 40}
    for name, first in starts.items():
        assert read(spark, log, str(tmp_path / f"c{name}"), str(tmp_path / f"o{name}"), startingOffset=name) == expected(first, 40)
    append(spark, log, 40, 55)
    for name, first in starts.items():  # the position of the checkpoint, not the option, counts now
        assert read(spark, log, str(tmp_path / f"c{name}"), str(tmp_path / f"o{name}"), startingOffset="earliest") == expected(first, 55)
    with pytest.raises(Exception, match="startingOffset"):
        read(spark, log, str(tmp_path / "c"), str(tmp_path / "o"), startingOffset="soon")


def test_restarts_leave_no_gaps_and_repeat_nothing(spark, tmp_path):
    log, checkpoint, out = (str(tmp_path / name) for name in ("log", "state", "out"))
    end = 0
    for last in (10, 11, 30, 30, 47):
        append(spark, log, end, last)
        end = last
        assert read(spark, log, checkpoint, out, startingOffset="3") == expected(3, last)


def test_lost_messages_are_told(spark, tmp_path):
    log = tmp_path / "log"
    append(spark, str(log), 0, 21)
    (first, *_), _ = segments(str(log)), None
    (log / first.path.rsplit("/", 1)[1]).unlink()
    assert read(spark, str(log), str(tmp_path / "c1"), str(tmp_path / "o1")) == expected(7, 21)
    with pytest.raises(Exception, match="no longer in the log"):
        read(spark, str(log), str(tmp_path / "c2"), str(tmp_path / "o2"), startingOffset="2")
    found = read(spark, str(log), str(tmp_path / "c3"), str(tmp_path / "o3"), startingOffset="2", failOnDataLoss="false")
    assert found == expected(7, 21)


def test_unfinished_segments_are_not_read(spark, tmp_path):
    log = tmp_path / "log"
    append(spark, str(log), 0, 5)
    (log / f"{5:020d}-{9:010d}.jsonl.part").write_text("half")
    assert end_of(str(log)) == 5
    assert read(spark, str(log), str(tmp_path / "c"), str(tmp_path / "o")) == expected(0, 5)


def test_segments_appear_in_order_once_all_are_written(spark, tmp_path, monkeypatch):
    """A stream lists the log while it is written: it must never find a later message without the earlier."""
    log = str(tmp_path / "log")
    rows = [(n, "a\nb" if n == 30 else f"m{n}") for n in range(50)]
    with pytest.raises(Exception, match="line break"):
        append_messages(spark.createDataFrame(rows, "k int, value string"), log, ["k"], segment=7)
    assert end_of(log) == 0 and segments(log) == []  # segments that were written before are not seen
    seen, opened = [], message_log._open

    class Watched:
        def __init__(self, system):
            self.system = system

        def __getattr__(self, name):
            if name == "move":
                monkeypatch.setattr(message_log, "_open", opened)
                seen.append([(s.first, s.last) for s in segments(log)])
                monkeypatch.setattr(message_log, "_open", watched)
            return getattr(self.system, name)

    def watched(uri):
        system, path = opened(uri)
        return Watched(system), path

    monkeypatch.setattr(message_log, "_open", watched)
    assert append(spark, log, 0, 50) == 50
    every = [(n, min(n + 7, 50)) for n in range(0, 50, 7)]
    assert seen == [every[:n] for n in range(len(every))]
    assert read(spark, log, str(tmp_path / "c"), str(tmp_path / "o")) == expected(0, 50)


SPEC = TableSpec(key="k", label="y", types={"x": "double"}, options={}, label_values={"1": 1, "0": 0})


@pytest.fixture(scope="module")
def two_models(spark):
    rows = spark.createDataFrame([(float(n), int(n > 5)) for n in range(10)], "x double, y int")
    turned = rows.withColumn("y", 1 - F.col("y"))
    return [build_pipeline("log_reg", ["x"], "y").fit(data) for data in (rows, turned)]


def test_versions(spark, tmp_path, two_models):
    store = f"file:{tmp_path}/store"
    assert newest_version(spark, store) is None
    with pytest.raises(FileNotFoundError):
        load_version(spark, store)
    assert [publish_model(spark, model, store) for model in two_models] == [1, 2]
    two_models[0].write().save(f"{store}/version=000007/model")
    assert versions(spark, store) == [1, 2] and versions(spark, store, committed=False) == [1, 2, 7]
    assert newest_version(spark, store) == 2
    with pytest.raises(FileNotFoundError):
        load_version(spark, store, 7)
    assert publish_model(spark, two_models[0], store) == 8 == newest_version(spark, store)
    weights = [float(load_version(spark, store, v).stages[-1].coefficients[0]) for v in (1, 2, 8)]
    assert weights[0] == weights[2] > 0 > weights[1]


def test_a_running_stream_takes_up_new_versions(spark, tmp_path, two_models):
    log, store, out = (str(tmp_path / name) for name in ("log", "store", "out"))

    def more(first, last):
        rows = [(n, json.dumps({"k": str(n), "x": str(n % 10)})) for n in range(first, last)]
        append_messages(spark.createDataFrame(rows, "k int, value string"), log, ["k"])

    publish_model(spark, two_models[0], store)
    more(0, 20)
    messages = message_stream(spark, "message_log", {}, path=log)
    running = start_versioned_scoring(messages, ["k", "x"], store, SPEC, out, str(tmp_path / "state"), payload="value")
    running.processAllAvailable()
    two_models[1].write().save(f"{store}/version=000002/model")  # not finished
    more(20, 30)
    running.processAllAvailable()
    publish_model(spark, two_models[1], store)
    more(30, 50)
    running.processAllAvailable()
    running.stop()
    found = sorted((int(r.k), r.prediction, r.model_version) for r in spark.read.json(out).collect())
    assert found == [(n, float((n % 10 > 5) == (n < 30)), 1 if n < 30 else 3) for n in range(50)]
