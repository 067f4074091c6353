import datetime as dt

from pyspark.sql import functions as F

from meterlake import schemas, sinks
from meterlake.jobs import parser
from meterlake.plans import dashboard

NOW = dt.datetime(2024, 1, 2, 12)


def paths(tmp_path):
    return str(tmp_path / "lake"), str(tmp_path / "predictions")


def fill(spark, tmp_path):
    lake, predictions = paths(tmp_path)
    times = [NOW - dt.timedelta(minutes=10 * i) for i in range(100)]
    sinks.write_lake(
        spark.createDataFrame(
            [
                (f"m{i % 2}", t, t.date(), None, 230.0, 1.0, 0.5, 0.95, 50.0, 900.0 - i, 0)
                for i, t in enumerate(times)
            ],
            schemas.READING,
        ),
        lake,
    )
    sinks.write_predictions(
        spark.createDataFrame([("m0", t, 2.0, 1.0) for t in times], schemas.PREDICTION),
        predictions,
    )


def test_figures(spark, tmp_path):
    fill(spark, tmp_path)
    found = dashboard.tables(spark, *paths(tmp_path), F.lit(NOW).cast("timestamp"))
    assert tuple(found["grid_overview"].first()) == (2, 230.0, 1.0, "NOMINAL")
    # 73 ten-minute steps fall on the newest date.
    assert found["voltages"].count() == 73 * 2
    assert [r.energy_kwh for r in found["energy_by_meter"].collect()] == [900.0, 899.0]
    assert found["forecast_error"].first().error_pct == 50.0
    series = found["forecast_series"].collect()
    assert len(series) == 7 and series[-1].event_time == NOW
    log = found["recent_log"].collect()
    assert len(log) == 10 and log[0].event_time == NOW


def test_before_there_is_data(spark, tmp_path):
    found = dashboard.tables(spark, *paths(tmp_path), F.current_timestamp())
    assert tuple(found["grid_overview"].first()) == (0, 0.0, 0.0, "OFFLINE")
    assert all(t.count() == 0 for name, t in found.items() if name != "grid_overview")


def test_report_job(spark, tmp_path, capsys):
    fill(spark, tmp_path)
    lake, predictions = paths(tmp_path)
    args = parser().parse_args(
        ["report", "--lake", lake, "--predictions", predictions, "--as-of", "2024-01-02 12:00"]
    )
    assert args.run(spark, args) is None
    assert "NOMINAL" in capsys.readouterr().out
