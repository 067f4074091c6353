"""Training from stored sums."""

import datetime as dt
import random
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from meterlake import schemas, sinks
from meterlake.plans import model as power_model, moments
from meterlake.sources import runs


def lake_rows(spark, seed, days=(1, 2, 3), n=120, **fixed):
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        day = dt.date(2024, 1, draw.choice(days))
        row = dict(
            meter_id=f"m{i % 4}", event_time=dt.datetime.combine(day, dt.time(i % 24, i // 24)), date=day,
            voltage=draw.choice([None, float("nan")]) if i % 17 == 0 else 200 + draw.randrange(500) / 10,
            current=draw.randrange(900) / 100, power_factor=0.95,
            frequency=50 + draw.randrange(-20, 20) / 1000, power=draw.randrange(30_000) / 10_000,
        )
        rows.append(tuple((dict.fromkeys(schemas.READING.names) | row | fixed).values()))
    return spark.createDataFrame(rows, schemas.READING)


def terms(model, rows):
    return {r.term: r.value for r in power_model.train_report(model, rows).collect()}


def least_squares(rows):
    """Power on voltage, current and frequency."""
    data = rows.select(*moments.COLUMNS).dropna("any").toPandas()
    x = np.column_stack([np.ones(len(data)), *(data[c] - data[c].mean() for c in ("voltage", "current", "frequency"))])
    return np.linalg.lstsq(x, data["power"], rcond=None)[0][1:]


def test_sums_of_a_growing_lake(spark, tmp_path):
    """Late files of old dates included; each file is read once."""
    lake, target = str(tmp_path / "lake"), str(tmp_path / "sums")
    assert moments.update(spark, lake, target) == 0
    assert moments.fit(spark, target) is None
    whole = None
    for turn, days in enumerate([(1, 2), (3,), (1, 4), (2,)]):
        part = lake_rows(spark, turn, days)
        whole = part if whole is None else whole.unionByName(part)
        sinks.write_lake(part, lake)
        assert moments.update(spark, lake, target) == part.select(*moments.COLUMNS).dropna("any").count()
        assert moments.update(spark, lake, target) == 0
        # What has been counted need not be read again.
        for file in Path(lake).glob("date=*/*.parquet"):
            file.write_bytes(b"counted")
    found, direct = terms(moments.fit(spark, target), whole), terms(power_model.train(whole), whole)
    assert found == {k: v if v is None else pytest.approx(v, abs=1e-3) for k, v in direct.items()}
    weights = [found[c] for c in ("voltage", "current", "frequency")]
    assert weights == pytest.approx(least_squares(whole), rel=1e-6)
    assert len(runs.RunTable(spark, target).live()) <= 3


@pytest.mark.parametrize("fixed", [{"voltage": 230.0}, {"current": 1.0, "voltage": 1.0, "frequency": 50.0}])
def test_constant_features(spark, tmp_path, fixed):
    lake, target = str(tmp_path / "lake"), str(tmp_path / "sums")
    rows = lake_rows(spark, 9, **fixed)
    sinks.write_lake(rows, lake)
    moments.update(spark, lake, target)
    found = terms(moments.fit(spark, target), rows)
    assert all(found[c] is None for c in fixed) and found["power_factor"] is None
    mean = rows.select(*moments.COLUMNS).dropna("any").agg(F.avg("power")).first()[0]
    if len(fixed) == 3:
        assert found["level"] == pytest.approx(mean) and found["r2"] == pytest.approx(0, abs=1e-6)


def test_no_complete_rows(spark, tmp_path):
    lake, target = str(tmp_path / "lake"), str(tmp_path / "sums")
    sinks.write_lake(lake_rows(spark, 1, current=None), lake)
    assert moments.update(spark, lake, target) == 0
    assert moments.fit(spark, target) is None
    assert moments.train_and_save(spark, lake, target, str(tmp_path / "model")) is None
