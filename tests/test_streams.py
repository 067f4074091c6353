"""Jobs over a folder of message files standing in for a topic."""

import datetime as dt
import json
import os

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from meterlake.operators import alerts, clean, report, shape
from meterlake.plans import catalog, model as power_model
from meterlake.sources import files, runs
from meterlake.streaming import jobs

START = dt.datetime(2024, 1, 1)


def text_of(i, day=0):
    time = START + dt.timedelta(days=day, minutes=i)
    return json.dumps(
        {
            "meter_id": f"m{i % 3}",
            "timestamp": time.strftime("%Y-%m-%dT%H:%M:%S.000Z"),
            "measurements": {
                "voltage_v": 200.0 + i % 50,
                "current_a": float(i % 7),
                "active_power_kw": -1.0 if i % 11 == 0 else i % 7 * 0.2 + i % 50 * 0.01,
                "power_factor": 0.95,
                "frequency_hz": 50.0 + i % 5 / 100,
            },
        }
    )


class Topic:
    def __init__(self, spark, folder):
        self.spark, self.folder = spark, folder
        folder.mkdir()

    def send(self, name, texts):
        (self.folder / name).write_text("\n".join([*texts, "not json"]))

    def stream(self):
        return self.spark.readStream.text(str(self.folder))

    def batch(self):
        return self.spark.read.text(str(self.folder))


@pytest.fixture
def topic(spark, tmp_path):
    topic = Topic(spark, tmp_path / "topic")
    topic.send("1", [text_of(i) for i in range(200)])
    return topic


def sorted_rows(df):
    return sorted(map(repr, df.collect()))


def cleaned_batch(topic):
    return clean.clean_readings(shape.flatten(shape.decode_messages(topic.batch())))


def ingest(topic, tmp_path):
    paths = str(tmp_path / "lake"), str(tmp_path / "ingest-checkpoint")
    jobs.start_ingest(topic.stream(), *paths, jobs.ONCE).awaitTermination()
    return files.read_lake(topic.spark, paths[0])


def test_repeats_are_left_out_over_batches_and_restarts(topic, tmp_path):
    """The same messages in a later file, a late day among them, with and without the option."""
    paths = str(tmp_path / "once"), str(tmp_path / "once-checkpoint")
    left_out = 0
    for name, texts in [
        ("2", [text_of(i) for i in range(150)] * 2),
        ("3", [text_of(i, day=-5) for i in range(50)] * 2),
    ]:
        query = jobs.start_ingest(topic.stream(), *paths, jobs.ONCE, repeats_within="1 hour")
        query.awaitTermination()
        left_out += jobs.repeats_left_out(query)
        topic.send(name, texts)
    query = jobs.start_ingest(topic.stream(), *paths, jobs.ONCE, repeats_within="1 hour")
    query.awaitTermination()
    left_out += jobs.repeats_left_out(query)
    once, every = files.read_lake(topic.spark, paths[0]), ingest(topic, tmp_path)
    assert sorted_rows(once) == sorted_rows(cleaned_batch(topic).distinct())
    assert left_out == every.count() - once.count() > 0
    assert clean.repeated_readings(once).isEmpty()
    assert clean.repeated_readings(every).agg(F.sum("repeats")).first()[0] == left_out


def test_repeats_beyond_the_age_pass(topic, tmp_path):
    paths = str(tmp_path / "once"), str(tmp_path / "once-checkpoint")
    jobs.start_ingest(topic.stream(), *paths, jobs.ONCE, repeats_within="0 seconds").awaitTermination()
    topic.send("2", [text_of(i) for i in range(50)])
    jobs.start_ingest(topic.stream(), *paths, jobs.ONCE, repeats_within="0 seconds").awaitTermination()
    lake = files.read_lake(topic.spark, paths[0])
    assert sorted_rows(lake) == sorted_rows(cleaned_batch(topic))


def test_ingest_equals_batch_and_restarts(topic, tmp_path):
    assert sorted_rows(ingest(topic, tmp_path)) == sorted_rows(cleaned_batch(topic))
    # A late day arrives before the restart; nothing is lost or repeated.
    topic.send("2", [text_of(i, day=-5) for i in range(50)])
    topic.send("3", [text_of(i, day=1) for i in range(50)])
    lake = ingest(topic, tmp_path)
    assert sorted_rows(lake) == sorted_rows(cleaned_batch(topic))
    assert {p.name for p in (tmp_path / "lake").glob("date=*")} == {
        "date=2023-12-27",
        "date=2024-01-01",
        "date=2024-01-02",
    }
    assert sorted_rows(ingest(topic, tmp_path)) == sorted_rows(lake)


def test_files_per_date(topic, tmp_path):
    for i in range(6):
        topic.send(f"more-{i}", [text_of(j, day=i % 2) for j in range(i, 200, 6)])
    paths = str(tmp_path / "lake"), str(tmp_path / "checkpoint")
    query = jobs.start_ingest(topic.stream(), *paths, jobs.ONCE, files_per_date=2)
    query.awaitTermination()
    for date in ("2024-01-01", "2024-01-02"):
        assert 1 <= len(list((tmp_path / "lake" / f"date={date}").glob("*.parquet"))) <= 2
    lake = files.read_lake(topic.spark, paths[0])
    assert sorted_rows(lake) == sorted_rows(cleaned_batch(topic))


def test_two_queries_follow_one_topic(topic, tmp_path):
    spark = topic.spark
    model = power_model.train(cleaned_batch(topic))
    first = jobs.start_scoring(
        topic.stream(), model, str(tmp_path / "p"), str(tmp_path / "pc"), jobs.ONCE
    )
    second = jobs.start_alerts(
        topic.stream(), [alerts.OverVoltage()], str(tmp_path / "a"), str(tmp_path / "ac"), jobs.ONCE
    )
    first.awaitTermination()
    assert jobs.wait_for_all(second) == []

    features = shape.scoring_projection(shape.decode_messages(topic.batch()))
    batch = power_model.score(model, features)
    assert sorted_rows(files.read_predictions(spark, str(tmp_path / "p"))) == sorted_rows(batch)

    raised = [json.loads(r.value) for r in jobs.read_alerts(spark, str(tmp_path / "a")).collect()]
    want = cleaned_batch(topic).where("voltage > 240").count()
    assert len(raised) == want > 0
    assert raised[0]["type"] == "CRITICAL"


class DividesByZero(alerts.AlertRule):
    """Fits the readings, and fails when it meets one."""

    def alert(self, readings):
        broken = F.assert_true(readings["voltage"] < 0).isNull() & F.lit(True)
        return F.when(broken, F.struct(*(F.lit("x").alias(f) for f in alerts.ALERT_FIELDS)))


def test_failing_rule_stops_no_other(topic, tmp_path):
    rules = [DividesByZero(), alerts.OverVoltage()]
    paths = str(tmp_path / "a"), str(tmp_path / "ac")
    failed = jobs.wait_for_all(jobs.start_alerts(topic.stream(), rules, *paths, jobs.ONCE))
    assert len(failed) == 1
    raised = jobs.read_alerts(topic.spark, paths[0]).count()
    assert raised == cleaned_batch(topic).where("voltage > 240").count() > 0


def test_error_of_a_rule_is_raised_after_all_have_ended(topic, tmp_path):
    rules = [DividesByZero(), alerts.OverVoltage()]
    queries = jobs.start_alerts(
        topic.stream(), rules, str(tmp_path / "a"), str(tmp_path / "ac"), jobs.ONCE
    )
    with pytest.raises(StreamingQueryException, match="USER_RAISED_EXCEPTION"):
        jobs.finish_all(queries)
    assert not any(query.isActive for query in queries)
    raised = topic.spark.read.text(str(tmp_path / "a/1-OverVoltage")).count()
    assert raised == cleaned_batch(topic).where("voltage > 240").count() > 0
    jobs.finish_all(queries[1:])
    jobs.finish_all([])


def test_stream_alerts_gives_no_result_when_its_rule_fails(topic, monkeypatch):
    """The rule fails in the second batch; the first one's alerts are there and not all."""
    topic.send("2", [text_of(i, day=1) for i in range(200)])
    for number in (1, 2):  # files are read from the oldest on
        os.utime(topic.folder / str(number), (number, number))
    reader = topic.spark.readStream.option("maxFilesPerTrigger", 1)
    monkeypatch.setattr(catalog, "message_stream", lambda *_: reader.text(str(topic.folder)))
    build, over_voltage = catalog.QUERIES["stream_alerts"], alerts.OverVoltage.alert
    want = cleaned_batch(topic).where("voltage > 240").count()
    assert build(topic.spark, "").count() == want > 0

    def fails_on_the_second_day(rule, readings):
        works = F.assert_true(readings["event_time"] < "2024-01-02").isNull()
        return F.when(works, over_voltage(rule, readings))

    monkeypatch.setattr(alerts.OverVoltage, "alert", fails_on_the_second_day)
    with pytest.raises(StreamingQueryException, match="USER_RAISED_EXCEPTION"):
        build(topic.spark, "")


def test_windows_are_complete(topic, tmp_path):
    paths = str(tmp_path / "w"), str(tmp_path / "wc")

    def run():
        jobs.start_window_energy(
            topic.stream(), *paths, length="1 hour", digits=4, trigger=jobs.ONCE
        ).awaitTermination()
        return jobs.read_window_energy(topic.spark, paths[0], 4)

    def batch():
        return report.window_energy(cleaned_batch(topic), "1 hour", 4)

    assert sorted_rows(run()) == sorted_rows(batch())
    topic.send("2", [text_of(i, day=-9) for i in range(90)])  # very late
    topic.send("3", [text_of(i, day=1) for i in range(50)])
    assert sorted_rows(run()) == sorted_rows(batch())


def test_windows_of_several_checkpoints(topic, tmp_path):
    """A new checkpoint adds to the path, a batch that runs again counts once, runs stay few."""
    path = str(tmp_path / "w")

    def run(checkpoint):
        jobs.start_window_energy(
            topic.stream(), path, str(tmp_path / checkpoint), "1 hour", 4, jobs.ONCE
        ).awaitTermination()
        return sorted_rows(jobs.read_window_energy(topic.spark, path, 4))

    assert jobs.read_window_energy(topic.spark, path, 4).collect() == []
    want = report.window_energy(cleaned_batch(topic), "1 hour", 4)
    assert run("c1") == sorted_rows(want)
    first = cleaned_batch(topic).count()
    doubled = sorted_rows(
        want.selectExpr(
            "meter_id", "window_start", "window_end", "2 * readings AS readings",
            "2 * energy_kwh AS energy_kwh",
        )
    )
    assert run("c2") == doubled
    # The query stopped before Spark noted that the batch was done.
    for done in (tmp_path / "c2/commits").iterdir():
        done.unlink()
    assert run("c2") == doubled
    for turn in range(3, 9):
        topic.send(str(turn), [text_of(i, day=turn) for i in range(40)])
        run("c1")
    live = runs.RunTable(topic.spark, path).live()
    assert len(live) <= 6
    found = jobs.read_window_energy(topic.spark, path, 4).groupBy().sum("readings").first()[0]
    assert found == cleaned_batch(topic).count() + first


def test_closed_windows_follow_the_watermark(topic, tmp_path):
    paths = str(tmp_path / "w"), str(tmp_path / "wc")
    query = jobs.start_closed_windows(
        topic.stream(), *paths, length="1 hour", lateness="10 minutes", trigger=jobs.ONCE
    )
    query.awaitTermination()
    rows = topic.spark.read.parquet(paths[0]).collect()
    # Readings end at 03:19, so the watermark is 03:09.
    assert {r.window_end.hour for r in rows} == {1, 2, 3}
    assert {r.meter_id for r in rows} == {"m0", "m1", "m2"}
    closed = cleaned_batch(topic).where("hour(event_time) < 3")
    want = closed.selectExpr("sum(power) * 0.5 AS kwh").first().kwh
    assert sum(r.energy_kwh for r in rows) == pytest.approx(want)
