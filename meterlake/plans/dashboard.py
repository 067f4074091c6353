"""The figures of the monitoring page, from a lake and a predictions folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from meterlake.operators import clean, report, shape
from meterlake.sources import files

TIE_BREAK = ("meter_id",)
# Sizes of the charts and lists.
VOLTAGE_ROWS = 100
FORECAST_ROWS = 60
LOG_ROWS = 10
FORECAST_HOURS = 1


def tables(
    spark: SparkSession,
    lake_path: str,
    predictions_path: str,
    as_of: Column,
    skip_corrupt: bool = False,
    compacted: str | None = None,
) -> dict[str, DataFrame]:
    """Reports over the newest date of the lake and the last hour of predictions.

    Sources that do not exist yet give an OFFLINE grid and empty tables. With `skip_corrupt`
    the figures leave out files that cannot be read, and `skipped_files` names those of the whole
    lake; else such a file is an error.
    """
    readings = files.read_latest_partition(spark, lake_path, skip_corrupt, compacted)
    since = as_of - F.make_interval(hours=F.lit(FORECAST_HOURS))
    predictions = clean.since(
        files.read_predictions(spark, predictions_path, since), as_of, FORECAST_HOURS
    )
    found = {
        "grid_overview": report.grid_overview(readings, tie_break=TIE_BREAK),
        "voltages": report.voltage_filled(readings, VOLTAGE_ROWS, TIE_BREAK),
        "energy_by_meter": report.energy_by_meter(readings),
        "forecast_error": report.forecast_error(predictions, TIE_BREAK),
        "forecast_series": report.newest_rows_ascending(predictions, FORECAST_ROWS, TIE_BREAK),
        "recent_log": shape.log_view(report.newest_rows(readings, LOG_ROWS, TIE_BREAK)),
    }
    if skip_corrupt:
        found["skipped_files"] = files.files_without_rows(spark, lake_path)
    return found
