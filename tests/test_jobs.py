"""The commands, with folders of text files in place of Kafka topics."""

import datetime as dt
import json

import pytest

from meterlake import jobs, schemas, sinks
from meterlake.plans import model as power_model
from meterlake.sources import files, kafka
from meterlake.streaming import jobs as streams

START = dt.datetime(2024, 1, 1)


@pytest.fixture
def topics(spark, tmp_path, monkeypatch):
    """Topics as folders; the session of the tests stays the session of the commands."""

    def read_topic(spark, servers, topic, *_):
        return spark.readStream.text(f"{servers}/{topic}")

    def write_topic(messages, servers, topic):
        messages.write.mode("append").text(f"{servers}/{topic}")

    def stream_to_topic(messages, servers, topic):
        return messages.writeStream.format("text").option("path", f"{servers}/{topic}")

    monkeypatch.setattr(kafka, "read_topic", read_topic)
    monkeypatch.setattr(kafka, "write_topic", write_topic)
    monkeypatch.setattr(kafka, "stream_to_topic", stream_to_topic)
    monkeypatch.setattr(jobs, "build_session", lambda *_: spark)
    history = spark.createDataFrame(
        [
            (f"m{i % 3}", START + dt.timedelta(minutes=i // 3), "London", "Camden", "0,0",
             200.0 + i % 50, i % 7 * 1.0, i % 7 * 0.2 + i % 50 * 0.01, 0.95, 50.0 + i % 5 / 100,
             i * 1.0, 0, "OK", 100)
            for i in range(240)
        ],
        schemas.HISTORY,
    )
    sinks.write_history(history, str(tmp_path / "history"))
    return tmp_path


def run(*words):
    assert jobs.main([str(word) for word in words]) == 0


def test_commands_in_turn(spark, topics):
    servers, lake = topics / "topics", topics / "lake"
    follow = ("--servers", servers, "--once", "--checkpoint")
    run("publish", "--history", topics / "history", "--servers", servers,
        "--start", "2024-03-01 00:00:00", "--interval", 900)
    sent = [json.loads(r.value) for r in spark.read.text(f"{servers}/{kafka.READINGS_TOPIC}").collect()]
    assert len({(m["meter_id"], m["timestamp"]) for m in sent}) == len(sent) == 240
    assert min(m["timestamp"] for m in sent) == "2024-03-01T00:00:00.000Z"

    run("ingest", "--lake", lake, *follow, topics / "c1")
    readings = files.read_lake(spark, str(lake))
    assert readings.count() == 240 and readings.select("event_time").distinct().count() == 80

    run("train", "--lake", lake, "--model", topics / "model")
    assert power_model.load(str(topics / "model")) is not None
    predictions = topics / "predictions"
    run("score", "--model", topics / "model", "--predictions", predictions, *follow, topics / "c2")
    assert files.read_predictions(spark, str(predictions)).count() == 240

    run("alert", *follow, topics / "c3")
    raised = spark.read.text(f"{servers}/{kafka.ALERTS_TOPIC}").count()
    assert raised == readings.where("voltage > 240").count() > 0

    run("windows", "--windows", topics / "windows", "--length", "6 hours", *follow, topics / "c4")
    windows = streams.read_window_energy(spark, str(topics / "windows"))
    assert windows.groupBy().sum("readings").first()[0] == 240
    run("consumption", "--windows", topics / "windows", "--out", topics / "consumption")
    assert spark.read.parquet(str(topics / "consumption")).count() == windows.count()

    compacted = ("--compacted", topics / "compact")
    run("compact", "--lake", lake, "--target", topics / "compact", "--date", "2024-03-01")
    both = files.read_compacted_lake(spark, str(lake), str(topics / "compact"))
    assert both.count() == 240
    run("compact", "--lake", lake, "--target", topics / "compact")
    run("train", "--lake", lake, "--model", topics / "model2", *compacted)
    assert power_model.load(str(topics / "model2")) is not None

    run("train", "--lake", lake, "--model", topics / "model3", "--moments", topics / "sums")
    assert power_model.load(str(topics / "model3")) is not None
    run("windows", "--windows", topics / "days", "--length", "1 day", *follow, topics / "c5")
    run("forecast", "--windows", topics / "days", "--out", topics / "forecast2")
    assert jobs.main(["forecast", "--out", str(topics / "forecast3")]) == 1

    run("forecast", "--lake", lake, "--out", topics / "forecast", "--digits", 4, *compacted)
    assert spark.read.parquet(str(topics / "forecast")).columns[-1] == "forecast_kwh"

    run("report", "--lake", lake, "--predictions", predictions, "--out", topics / "report",
        "--as-of", "2024-03-01 20:00:00", *compacted)
    assert spark.read.parquet(str(topics / "report/energy_by_meter")).count() == 3
    assert spark.read.parquet(str(topics / "report/forecast_series")).count() > 0


def test_commands_without_input(spark, topics, capsys):
    args = ["score", "--model", str(topics / "none"), "--predictions", "p", "--servers", "s",
            "--checkpoint", "c"]
    assert jobs.main(args) == 1
    assert "no model" in capsys.readouterr().err
