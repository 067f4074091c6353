import numpy as np
import pytest

from meterlake import schemas
from meterlake.jobs import parser
from meterlake.plans import model as power_model
from meterlake.sinks import write_lake


@pytest.fixture(scope="module")
def readings(spark):
    rng = np.random.default_rng(1)
    rows = []
    for i in range(500):
        volts, amps, hertz = 230 + rng.normal(), rng.uniform(0.1, 8), 50 + rng.normal() / 50
        power = volts * amps * 0.95 / 1000 * rng.uniform(0.95, 1.05)
        rows.append((volts, amps, 0.95, hertz, None if i % 50 == 0 else float(power)))
    frame = spark.createDataFrame(
        [tuple(None if v is None else float(v) for v in r) for r in rows],
        "voltage double, current double, power_factor double, frequency double, power double",
    )
    return frame.selectExpr(
        "*", "'m' AS meter_id", "TIMESTAMP'2024-01-01' AS event_time", "DATE'2024-01-01' AS date"
    )


def test_predictions_equal_least_squares(readings):
    model = power_model.train(readings)
    scored = power_model.score(model, readings.withColumnRenamed("power", "actual_power"))
    known = readings.dropna().toPandas()
    x = np.c_[known.voltage, known.current, known.frequency, np.ones(len(known))]
    want = x @ np.linalg.lstsq(x, known.power, rcond=None)[0]
    got = scored.toPandas()
    assert list(got.columns) == schemas.PREDICTION.names
    assert np.allclose(sorted(got.predicted_power), sorted(want), atol=1e-3)

    report = {r.term: r.value for r in power_model.train_report(model, readings).collect()}
    assert report["power_factor"] is None
    assert report["rows"] == 490
    assert report["current"] == pytest.approx(0.2185, abs=0.01)
    assert report["rmse"] == pytest.approx(np.sqrt(np.mean((want - known.power) ** 2)), abs=1e-5)
    fit = 1 - np.sum((want - known.power) ** 2) / np.sum((known.power - known.power.mean()) ** 2)
    assert report["r2"] == pytest.approx(fit, abs=1e-6)


def test_no_complete_rows_no_model(readings):
    assert power_model.train(readings.where("power IS NULL")) is None


def test_save_replaces_and_load_of_nothing(spark, readings, tmp_path):
    path = str(tmp_path / "model")
    assert power_model.load(path) is None
    lake = str(tmp_path / "lake")
    assert power_model.train_and_save(spark, lake, path) is None
    write_lake(readings, lake)
    for _ in range(2):
        model = power_model.train_and_save(spark, lake, path)
    features = readings.withColumnRenamed("power", "actual_power")
    again = power_model.score(power_model.load(path), features)
    assert again.collect() == power_model.score(model, features).collect()


def test_train_job(spark, readings, tmp_path, capsys):
    paths = ["--lake", str(tmp_path / "lake"), "--model", str(tmp_path / "model")]
    train = parser().parse_args(["train", *paths])
    assert "no complete readings" in train.run(spark, train)
    write_lake(readings, paths[1])
    assert train.run(spark, train) is None
    assert "rmse" in capsys.readouterr().out

    topic = ["--servers", "none:9092", "--checkpoint", str(tmp_path / "c")]
    lost = ["--model", str(tmp_path / "lost"), "--predictions", str(tmp_path / "p")]
    score = parser().parse_args(["score", *topic, *lost])
    assert "no model" in score.run(spark, score)
