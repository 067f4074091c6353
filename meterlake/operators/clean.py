"""Row filters. All are stateless, so they run on streams too."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from meterlake import schemas


def clean_readings(readings: DataFrame) -> DataFrame:
    """Drop rows without meter or time, with voltage <= 0 or with negative power.

    A missing voltage or power is a switched-off metric and stays.
    """
    return readings.where(
        F.col("meter_id").isNotNull()
        & F.col("event_time").isNotNull()
        & (F.coalesce("voltage", F.lit(1.0)) > 0)
        & (F.coalesce("power", F.lit(0.0)) >= 0)
    )


def training_rows(readings: DataFrame) -> DataFrame:
    """Features and label of the rows that have them all."""
    return readings.select(*schemas.FEATURES, schemas.LABEL).dropna("any")


def scoring_rows(features: DataFrame) -> DataFrame:
    """Rows with no NULL or NaN in any column."""
    return features.dropna("any")


def since(df: DataFrame, as_of: Column, hours: int = 1) -> DataFrame:
    """Rows of the last `hours` before `as_of`."""
    return df.where(F.col("event_time") >= as_of - F.expr(f"INTERVAL {hours} HOURS"))


def only_meters(df: DataFrame, meters: Sequence[str] | DataFrame) -> DataFrame:
    """Rows of the given meters, as a list or as a table with `meter_id`."""
    if isinstance(meters, DataFrame):
        return df.join(meters, "meter_id", "left_semi")
    return df.where(F.col("meter_id").isin(list(meters)))


def repeated_readings(lake: DataFrame) -> DataFrame:
    """`meter_id, event_time, date, repeats` (long): readings that stand in the lake more than
    once, equal in every column, and how often too many."""
    counted = lake.groupBy(*lake.columns).agg((F.count("*") - 1).alias("repeats"))
    return counted.where("repeats > 0").select("meter_id", "event_time", "date", "repeats")
