import datetime as dt
import math
import random
from collections import Counter

import pandas as pd
import pytest
from pyspark.sql import functions as F

from meterlake import schemas
from meterlake.operators import fleet, report, sampling

NAN = float("nan")
START = dt.datetime(2024, 1, 1)


def readings(spark, rows):
    """Rows of (meter_id, minute, {column: value})."""
    full = []
    for meter, minute, values in rows:
        time = START + dt.timedelta(minutes=minute)
        row = dict.fromkeys(schemas.READING.names) | values
        full.append(tuple((row | dict(meter_id=meter, event_time=time, date=time.date())).values()))
    return spark.createDataFrame(full, schemas.READING)


def overview(spark, rows):
    (row,) = report.grid_overview(readings(spark, rows)).collect()
    return tuple(row)


def test_overview_without_readings(spark):
    assert overview(spark, []) == (0, 0.0, 0.0, "OFFLINE")


def test_overview_takes_the_newest_whole_row(spark):
    rows = [
        ("a", 0, dict(voltage=500.0, power=9.0)),
        ("a", 5, dict(voltage=240.0, power=1.5)),
        ("b", 3, dict(voltage=None, power=2.0)),
        ("b", 1, dict(voltage=100.0, power=8.0)),
    ]
    assert overview(spark, rows) == (2, 240.0, 3.5, "NOMINAL")


@pytest.mark.parametrize(
    "volts,status",
    [(199.9, "UNSTABLE"), (200.0, "NOMINAL"), (240.0, "NOMINAL"), (240.1, "UNSTABLE")],
)
def test_status_limits(spark, volts, status):
    assert overview(spark, [("a", 0, dict(voltage=volts, power=1.0))])[3] == status


def test_overview_skips_nan_and_survives_all_null(spark):
    rows = [("a", 0, dict(voltage=NAN, power=NAN)), ("b", 0, dict(voltage=230.0, power=1.0))]
    assert overview(spark, rows) == (2, 230.0, 1.0, "NOMINAL")
    assert overview(spark, [("a", 0, {})]) == (1, None, 0.0, "UNSTABLE")


def test_energy_ranking_puts_unknown_last(spark):
    rows = [
        ("a", 0, dict(energy=5.0)),
        ("a", 1, dict(energy=NAN)),
        ("b", 0, dict(energy=NAN)),
        ("c", 0, dict(energy=7.0)),
        ("c", 1, dict(energy=6.0)),
    ]
    ranked = report.energy_by_meter(readings(spark, rows)).collect()
    assert [tuple(r) for r in ranked] == [("c", 7.0), ("a", 5.0), ("b", None)]


def random_voltages(seed):
    rng = random.Random(seed)
    return [
        (f"m{rng.randrange(8)}", minute, dict(voltage=rng.choice([None, rng.randrange(400) / 2])))
        for minute in range(160)
    ]


def pandas_pivot(rows, fill):
    frame = pd.DataFrame([(m, t, v["voltage"]) for m, t, v in rows[-100:]], columns=list("mtv"))
    table = frame.pivot_table(index="t", columns="m", values="v", aggfunc="first")
    if fill:
        table = table.ffill().bfill()
    return {(t, m): v for (t, m), v in table.stack(future_stack=True).items()}


def minute_of(time):
    return int((time - START).total_seconds() // 60)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_pivot_and_fill_equal_pandas(spark, seed):
    rows = random_voltages(seed)
    frame = readings(spark, rows)

    filled = report.voltage_filled(frame).collect()
    assert {(minute_of(r.event_time), r.meter_id): r.voltage for r in filled} == pandas_pivot(
        rows, fill=True
    )

    pivot = report.voltage_pivot(frame)
    cells = {
        (minute_of(r.event_time), meter): r[meter]
        for r in pivot.collect()
        for meter in pivot.columns[1:]
    }
    want = {k: None if math.isnan(v) else v for k, v in pandas_pivot(rows, fill=False).items()}
    assert cells == want


def test_pivot_with_given_meters(spark):
    frame = readings(spark, random_voltages(1))
    assert report.voltage_pivot(frame, meters=["m1", "m2"]).columns == ["event_time", "m1", "m2"]


def test_fill_without_points(spark):
    assert report.voltage_filled(readings(spark, [("a", 0, {})])).count() == 0


def test_newest_rows_in_both_directions(spark):
    frame = readings(spark, [(f"m{i}", i, {}) for i in range(9)])
    assert [r.meter_id for r in report.newest_rows(frame, 3).collect()] == ["m8", "m7", "m6"]
    charted = report.newest_rows_ascending(frame, 3).collect()
    assert [r.meter_id for r in charted] == ["m6", "m7", "m8"]


def predictions(spark, rows):
    full = [("m", START + dt.timedelta(minutes=i), a, p) for i, (a, p) in enumerate(rows)]
    return spark.createDataFrame(full, schemas.PREDICTION)


def test_forecast_error_of_the_newest(spark):
    (row,) = report.forecast_error(predictions(spark, [(9.0, 0.0), (2.0, 1.5)])).collect()
    assert (row.error_kw, row.error_pct) == (0.5, 25.0)
    (row,) = report.forecast_error(predictions(spark, [(0.0, 1.5)])).collect()
    assert (row.error_kw, row.error_pct) == (1.5, 0.0)
    assert report.forecast_error(predictions(spark, [])).count() == 0


def test_residual_tolerance(spark):
    inputs = dict(voltage=200.0, current=10.0, power_factor=0.5)
    rows = [("a", 0, inputs | dict(power=1.04)), ("b", 0, inputs | dict(power=1.06))]
    got = {r.meter_id: r for r in report.power_residual(readings(spark, rows)).collect()}
    assert got["a"].ideal_power == 1.0
    assert [got[m].out_of_tolerance for m in "ab"] == [False, True]


def test_band_limits(spark):
    rows = [("a", 60 * hour + 59, dict(power=1.0)) for hour in range(24)]
    got = {r.band: r.readings for r in report.load_bands(readings(spark, rows)).collect()}
    assert got == {"night": 6, "morning": 4, "peak": 6, "day": 8}


def test_consumption_adds_up(spark):
    rows = [("a", 60 * 24 * day, dict(power=2.0)) for day in (0, 1, 31, 400)]
    rows += [("a", 1, dict(power=NAN))]
    got = {
        (r.grain, str(r.period_start)): r.energy_kwh
        for r in report.consumption_rollup(readings(spark, rows)).collect()
    }
    assert got[("day", "2024-01-01")] == 1.0
    assert got[("month", "2024-01-01")] == 2.0
    assert got[("month", "2024-02-01")] == 1.0
    assert got[("year", "2024-01-01")] == 3.0
    assert got[("year", "2025-01-01")] == 1.0


def test_forecast_starts_on_the_third_day(spark):
    rows = [("a", 60 * 24 * day, dict(power=2.0)) for day in (0, 1, 2, 9)]
    got = report.month_forecast(readings(spark, rows)).orderBy("date").collect()
    assert [(r.date.day, r.month_to_date_kwh, r.forecast_kwh) for r in got] == [
        (3, 3.0, 31.0),
        (10, 4.0, 4.0 * 31 / 10),
    ]


@pytest.mark.parametrize("digits", [None, 4])
def test_summary(spark, digits):
    rows = [("a", 0, dict(power=1.0)), ("a", 2, dict(power=2.0)), ("b", 1, dict(power=NAN))]
    (row,) = report.lake_summary(readings(spark, rows), digits).collect()
    assert tuple(row) == (3, 1.5, START + dt.timedelta(minutes=2))
    (row,) = report.lake_summary(readings(spark, []), digits).collect()
    assert tuple(row) == (0, None, None)


def test_totals_do_not_depend_on_row_order(spark):
    rng = random.Random(5)
    rows = [("a", i, dict(power=rng.randrange(10**9) / 10**4)) for i in range(3000)]
    frame = readings(spark, rows)
    sums = {
        report.lake_summary(frame.repartition(n).orderBy(F.rand(n)), digits=4).first().avg_power_kw
        for n in (1, 3, 7)
    }
    assert len(sums) == 1


def test_ranks_and_shards(spark):
    rng = random.Random(6)
    ids = sorted({f"LCL-{rng.randrange(10**6)}" for _ in range(500)})
    rows = [(m, i, {}) for i, m in enumerate(ids + ids)]
    frame = readings(spark, rows)
    ranks = fleet.meter_ranks(frame).collect()
    assert {r.meter_id: r["rank"] for r in ranks} == {m: i for i, m in enumerate(ids)}
    shards = {r.meter_id: r.shard for r in fleet.meter_shards(frame, 5).collect()}
    assert shards == {m: i % 5 for i, m in enumerate(ids)}
    assert [r.meter_id for r in fleet.first_meters(frame).collect()] == ids[:5]
    assert [r.meter_id for r in fleet.distinct_meters(frame).collect()] == ids


def plain_counter(rows):
    """Energy and resets per meter and day, a reading at a time."""
    found, last = {}, {}
    for meter, minute, value in sorted(rows, key=lambda r: r[1]):
        if meter is None or value is None or math.isnan(value):
            continue
        day = (START + dt.timedelta(minutes=minute)).date()
        kwh, resets = found.get((meter, day), (0.0, 0))
        before = last.get(meter)
        if before is not None:
            kwh += value if value < before else value - before
            resets += value < before
        found[meter, day], last[meter] = (kwh, resets), value
    return found


@pytest.mark.parametrize("digits, step", [(3, "hour"), (None, "day"), (3, "minute")])
def test_consumption_from_a_counter(spark, digits, step):
    """Resets, gaps over days, NULL and NaN counters, one meter with most rows."""
    draw = random.Random(digits or 1)
    rows, counters = [], {}
    for minute in draw.sample(range(5 * 1440), 600):
        rows.append([draw.choice(["hot", "hot", "hot", "a", None]), minute, None])
    for row in sorted(rows, key=lambda r: r[1]):
        counter = counters.get(row[0], 900.0) + draw.randrange(5000) / 1000
        counters[row[0]] = 0.25 if draw.random() < 0.03 else counter
        row[2] = draw.choice([None, NAN]) if draw.random() < 0.1 else counters[row[0]]
    frame = readings(spark, [(m, minute, dict(energy=v)) for m, minute, v in rows])
    found = report.counter_rollup(frame, digits, step=step).collect()
    days = {(r.meter_id, r.period_start): (r.energy_kwh, r.resets) for r in found if r.grain == "day"}
    expected = plain_counter(rows)
    assert {k: v for k, v in days.items() if k[0]} == {
        k: (pytest.approx(kwh), resets) for k, (kwh, resets) in expected.items()
    }
    year = {r.meter_id: r.energy_kwh for r in found if r.grain == "year"}
    for meter in ("hot", "a"):
        assert year[meter] == pytest.approx(sum(v[0] for k, v in expected.items() if k[0] == meter))
    assert sum(r.resets for r in found if r.grain == "month") > 0
    assert report.counter_rollup(frame.limit(0), digits).collect() == []


@pytest.mark.parametrize("step, minutes", [("hour", 60), ("minute", 1), ("day", 1440)])
def test_fill_of_the_whole_table(spark, step, minutes):
    """Every meter has a voltage in every step; gaps at the start, inside and at the end."""
    draw = random.Random(minutes)
    rows = [("hot", draw.randrange(10 * minutes), 200.0 + i) for i in range(150)]
    rows += [("early", draw.randrange(minutes), 1.0 + i) for i in range(3)]
    rows += [("late", 12 * minutes + draw.randrange(minutes), 2.0)]
    rows += [("gap", 2 * minutes, 5.0), ("gap", 7 * minutes, 6.0), ("gap", 4 * minutes, None)]
    rows += [("gap", 5 * minutes, NAN), (None, 30 * minutes, 9.0), ("none", 40 * minutes, None)]
    frame = readings(spark, [(m, minute, dict(voltage=v)) for m, minute, v in rows])
    found = report.voltage_filled_all(frame, step, ("voltage",)).collect()
    known = [r for r in rows if r[0] and r[2] is not None and not math.isnan(r[2])]
    first, last = min(r[1] for r in known) // minutes, max(r[1] for r in known) // minutes
    wide = pd.DataFrame(index=range(first, last + 1))
    for meter in {r[0] for r in known}:
        own = sorted((minute, v) for m, minute, v in known if m == meter)
        wide[meter] = pd.Series({minute // minutes: v for minute, v in reversed(own)})
    wide = wide.ffill().bfill()
    expected = {
        (START + dt.timedelta(minutes=at * minutes), meter): wide.loc[at, meter]
        for at in wide.index for meter in wide.columns
    }
    assert len(found) == len(expected)
    assert {(r.event_time, r.meter_id): r.voltage for r in found} == expected
    assert report.voltage_filled_all(frame.limit(0)).collect() == []


@pytest.mark.parametrize("size", [1, 3, 50])
def test_sample_of_a_given_size(spark, size):
    """Every meter has its share, smaller samples are part of larger ones, runs agree."""
    rows = [("hot", i, dict(current=float(i))) for i in range(200)]
    rows += [(m, i, dict(current=float(i))) for m in "abc" for i in range(5)] + [(None, 1, {})]
    frame = readings(spark, rows)
    found = [tuple(r) for r in sampling.sample_per_meter(frame, size, ("current",)).collect()]
    again = sampling.sample_per_meter(frame.repartition(7), size, ("current",)).collect()
    assert sorted(found) == sorted(tuple(r) for r in again)
    assert Counter(r[0] for r in found) == {
        "hot": min(size, 200), **{m: min(size, 5) for m in "abc"}
    }
    larger = {tuple(r) for r in sampling.sample_per_meter(frame, size + 2, ("current",)).collect()}
    assert set(found) <= larger
    assert sampling.sample_per_meter(frame.limit(0), size).collect() == []
