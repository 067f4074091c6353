"""Repeatable sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def sample_readings(readings: DataFrame, percent: int) -> DataFrame:
    """About `percent` of the readings, chosen by a hash of meter and time.

    The same reading is in or out in every run and in any engine that has MD5.
    """
    bucket = F.conv(F.substring(_digest(), 1, 8), 16, 10).cast("long") % 100
    return readings.where(bucket < percent)


def sample_per_meter(
    readings: DataFrame, size: int, tie_break: tuple[str, ...] = ()
) -> DataFrame:
    """`size` readings of every meter, all of a meter that has fewer.

    Those with the smallest hash of meter and time, then time and `tie_break`: the same in every
    run, and a smaller sample is part of a larger one. Spark keeps `size` of a meter in each
    task before the shuffle, so a meter with most readings is no larger than others after it.
    Readings without a meter are left out.
    """
    order = Window.partitionBy("meter_id").orderBy("_digest", "event_time", *tie_break)
    return (
        readings.where(F.col("meter_id").isNotNull())
        .withColumn("_digest", _digest())
        .withColumn("_place", F.row_number().over(order))
        .where(F.col("_place") <= size)
        .drop("_digest", "_place")
    )


def _digest() -> Column:
    key = F.concat_ws(
        "@", "meter_id", F.unix_micros(F.col("event_time").cast("timestamp")).cast("string")
    )
    return F.md5(key.cast("binary"))
