"""Running totals against plain Python, in steps of several lengths."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from meterlake.operators import running

START = dt.datetime(2024, 1, 1)
ROWS = "meter_id string, event_time timestamp, event_id long, power double"


def history(seed, n=400):
    """One meter has most rows; times repeat and cross minutes; NULL keys and values occur."""
    rng = random.Random(seed)
    rows = []
    for event_id in range(n):
        meter = rng.choice(["hot", "hot", "hot", "a", "b", None])
        time = START + dt.timedelta(seconds=rng.randrange(600))
        if rng.random() < 0.02:
            time = None
        power = None if rng.random() < 0.1 else rng.randrange(100_000) / 10_000
        rows.append((meter, time, event_id, power))
    return rows


@pytest.fixture
def no_broadcast(spark):
    """Joins as of tables that are too large to be sent whole."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(name, -1)
    yield
    spark.conf.unset(name)


def by_meter(rows):
    groups = {}
    for row in sorted(rows, key=lambda r: (r[1] is not None, r[1] or START, r[2])):
        if row[0] is not None:
            groups.setdefault(row[0], []).append(row)
    return groups


@pytest.mark.parametrize("step", ["minute", "hour", "year"])
@pytest.mark.parametrize("seed", [1, 2])
def test_running_energy(spark, seed, step):
    rows = history(seed)
    got = running.running_energy(
        spark.createDataFrame(rows, ROWS),
        digits=4,
        tie_break=("event_id",),
        step=step,
    )
    assert got.columns == ["meter_id", "event_time", "event_id", "power", "energy_kwh"]
    want = {}
    for group in by_meter(rows).values():
        units = 0
        for row in group:
            units += round((row[3] or 0) * 10_000)
            want[row[2]] = units * 0.5 / 10_000
    assert {r.event_id: r.energy_kwh for r in got.collect()} == want


def test_running_total_shuffles_rows_once(spark, no_broadcast):
    """One shuffle of the rows and three of the sums per step, which meet the rows last."""
    frame = spark.createDataFrame(history(4), ROWS)
    total = running.running_total(frame, F.col("event_id"), "total", ("event_id",))
    plan = total._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and plan.count("Exchange hashpartitioning") == 4
    want, groups = {}, by_meter(history(4))
    for group in groups.values():
        for i, row in enumerate(group):
            want[row[2]] = sum(earlier[2] for earlier in group[: i + 1])
    assert {r.event_id: r.total for r in total.collect()} == want


@pytest.mark.parametrize("step", ["hour", "century"])
def test_rows_without_time_come_before_the_oldest(spark, no_broadcast, step):
    times = [dt.datetime(1969, 12, 31, 23, 59), None, dt.datetime(1970, 1, 1), dt.datetime(1, 1, 2), None]
    rows = [("a", time, i, 1.0) for i, time in enumerate(times)]
    got = running.row_positions(spark.createDataFrame(rows, ROWS), ("event_id",), step)
    assert [r.event_id for r in got.orderBy("position").collect()] == [1, 4, 3, 0, 2]


@pytest.mark.parametrize("step", ["minute", "hour"])
def test_row_positions(spark, step):
    rows = history(3)
    got = running.row_positions(
        spark.createDataFrame(rows, ROWS), tie_break=("event_id",), step=step
    )
    want = {r[2]: i for group in by_meter(rows).values() for i, r in enumerate(group)}
    assert {r.event_id: r.position for r in got.collect()} == want


def test_replay_starts_over(spark):
    rows = [("a", START + dt.timedelta(minutes=i), i, float(i)) for i in range(3)]
    rows += [("b", START, 10, 10.0)]
    frame = spark.createDataFrame(rows, ROWS)
    got = running.replay_schedule(frame, 2, 7, ("event_id",))
    sent = sorted((r.meter_id, r.tick, r.event_id) for r in got.collect())
    assert sent == [
        ("a", 2, 2), ("a", 3, 0), ("a", 4, 1), ("a", 5, 2), ("a", 6, 0),
        ("b", 2, 10), ("b", 3, 10), ("b", 4, 10), ("b", 5, 10), ("b", 6, 10),
    ]
    assert running.replay_schedule(frame, 5, 5, ("event_id",)).count() == 0
    assert running.replay_schedule(frame, 5, 4, ("event_id",)).count() == 0
    whole = running.replay_schedule(frame, 0, 3, ("event_id",)).collect()
    assert {r.tick for r in whole} == {0, 1, 2} and len(whole) == 6
    assert running.replay_schedule(frame, -5, 0, ("event_id",)).count() == 0
    assert running.replay_schedule(frame, -5, 1, ("event_id",)).count() == 2


def test_replay_makes_what_is_sent(spark, monkeypatch):
    """Every meter against plain counting, rounds in several blocks, spans far ahead."""
    monkeypatch.setattr(running, "ROUNDS", 3)
    sizes = {"a": 1, "b": 2, "c": 7, "d": 200, "e": 33}
    rows = [(m, START + dt.timedelta(minutes=i), i, 1.0) for m, n in sizes.items() for i in range(n)]
    frame = spark.createDataFrame(rows, ROWS)
    for first, end in ((0, 33), (5, 6), (1_000_003, 1_000_040), (150, 260)):
        sent = running.replay_schedule(frame, first, end, ("event_id",)).collect()
        assert sorted((r.meter_id, r.tick, r.event_id) for r in sent) == [
            (m, tick, tick % n) for m, n in sorted(sizes.items()) for tick in range(first, end)
        ]
        assert all(r.position == r.event_id for r in sent)


def test_replay_of_one_long_meter_makes_its_span_only(spark):
    """A long meter among many short ones: the work is the span, not meters times longest."""
    times = F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id"))
    long = spark.range(20_000).select(F.lit("long").alias("meter_id"), times.alias("event_time"))
    short = spark.range(200).select(F.concat(F.lit("m"), "id").alias("meter_id"), times.alias("event_time"))
    rows = long.unionByName(short)
    assert running.replay_schedule(rows, 19_990, 20_000).count() == 201 * 10
    plan = running.replay_schedule(rows, 0, 10)._jdf.queryExecution().optimizedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_stamped_times_stay_different(spark):
    rows = [("a", START, float(i)) for i in range(5)] + [("b", START, 9.0), (None, START, 1.0)]
    frame = spark.createDataFrame(rows, "meter_id string, timestamp timestamp, x double")
    got = running.stamped(frame, F.lit("2025-01-01 00:00:00").cast("timestamp"), 1.5).collect()
    times = {(r.meter_id, r.timestamp) for r in got}
    assert len(got) == len(times) == 6
    last = max(r.timestamp for r in got if r.meter_id == "a")
    assert last == dt.datetime(2025, 1, 1, 0, 0, 6)


@pytest.mark.parametrize("step", ["minute", "hour", "year"])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_value_before(spark, seed, step):
    """The last known value of the rows before, over steps without any."""
    rows = history(seed)
    frame = spark.createDataFrame(rows, ROWS)
    got = running.value_before(frame, F.col("power"), "before", ("event_id",), step).collect()
    expected = set()
    for group in by_meter(rows).values():
        last = None
        for row in group:
            expected.add((*row, last))
            last = row[3] if row[3] is not None else last
    assert {tuple(r) for r in got} == expected
    assert running.value_before(frame.limit(0), F.col("power"), "before").collect() == []
