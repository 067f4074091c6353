"""The message files that stand in for a topic, on events made here."""

import datetime as dt
from pathlib import Path
from urllib.parse import urlparse

import pytest

from meterlake import schemas
from meterlake.operators import shape
from meterlake.plans import catalog, fixture
from meterlake.streaming import jobs

EVENTS = """event_id long, ts timestamp_ntz, user_id long, event_type string, value double,
    props string"""
START = dt.datetime(2024, 1, 1)
COUNT = 2000


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    """Some readings come twice, some have no meter or no time."""
    rows = [
        (i, START + dt.timedelta(minutes=7 * i), i % 13, "click", i / 100, f'{{"k": {i % 100}}}')
        for i in range(COUNT - 6)
    ]
    rows += [rows[0], rows[0], rows[1]]
    rows += [(COUNT + i, None, i, "click", 1.0, '{"k": 1}') for i in range(2)]
    rows += [(COUNT + 2, START, None, "click", 1.0, '{"k": 1}')]
    path = tmp_path_factory.mktemp("events")
    spark.createDataFrame(rows, EVENTS).coalesce(1).write.parquet(fixture.events_path(str(path)))
    return str(path)


def texts(frame):
    return sorted(r.value for r in frame.collect())


def test_messages_are_stored_compressed(spark, sf_dir):
    """The texts repeat their keys; as they are, they are what a query writes most of."""
    path = catalog.messages_path(spark, sf_dir)
    sent = texts(catalog.messages(spark, sf_dir))
    want = shape.to_messages(
        catalog.nested(fixture.raw_with_energy(spark, sf_dir), schemas.METRICS)
    )
    assert len(sent) == COUNT - 1 and sent == texts(want)
    stored = sum(file.stat().st_size for file in Path(urlparse(path).path).glob("part-*"))
    assert stored < sum(map(len, sent)) / 3


def test_files_grow_with_the_messages(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(catalog, "MESSAGES_PER_FILE", COUNT // 25, raising=False)
    path = catalog.messages_path.__wrapped__(spark, sf_dir)
    monkeypatch.setattr(catalog, "messages_path", lambda *_: path)
    assert len(catalog.messages(spark, sf_dir).inputFiles()) == 25
    counts = []
    catalog.message_stream(spark, sf_dir, 2).writeStream.foreachBatch(
        lambda batch, _: counts.append(batch.count())
    ).trigger(**jobs.ONCE).start().awaitTermination()
    assert len(counts) == 2 and sum(counts) == COUNT - 1


def test_windows_meet_in_several_batches(spark, sf_dir):
    """Every file has readings of all meters and days, so that batches add to the same windows."""
    file = "_metadata.file_name"
    decoded = catalog.messages(spark, sf_dir).select("value", file)
    days = decoded.selectExpr("get_json_object(value, '$.timestamp') AS t", "file_name")
    met = days.selectExpr("left(t, 10) AS day", "file_name").where("day IS NOT NULL").distinct()
    assert met.groupBy("day").count().where("count > 4").count() == met.select("day").distinct().count()
