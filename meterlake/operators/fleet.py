"""The list of meters: distinct, first few, split over workers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from meterlake.session import scratch_path


def distinct_meters(readings: DataFrame) -> DataFrame:
    """Meter ids in order."""
    known = readings.where(F.col("meter_id").isNotNull())
    return known.select("meter_id").distinct().orderBy("meter_id")


def first_meters(readings: DataFrame, count: int = 5) -> DataFrame:
    """The first `count` meter ids in order."""
    return distinct_meters(readings).limit(count)


def meter_ranks(readings: DataFrame) -> DataFrame:
    """Each meter with its place in id order, from 0.

    The ids are sorted into ranges and written once, so that every later step sees the same
    ranges even if an executor is lost. A range is then ranked by itself and shifted by the
    size of the ranges before it; only range sizes pass through one task.
    """
    spark = readings.sparkSession
    path = scratch_path(spark, "meter-ranges")
    distinct_meters(readings).withColumn("range", F.spark_partition_id()).write.parquet(path)
    ranges = spark.read.schema("meter_id STRING, range INT").parquet(path)

    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    shifts = (
        ranges.groupBy("range")
        .agg(F.count("*").alias("size"))
        .select("range", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("shift"))
    )
    within = Window.partitionBy("range").orderBy("meter_id")
    return ranges.join(F.broadcast(shifts), "range").select(
        "meter_id", (F.row_number().over(within) - 1 + F.col("shift")).alias("rank")
    )


def meter_shards(readings: DataFrame, workers: int) -> DataFrame:
    """Deal the sorted meters out to `workers` in turn."""
    return meter_ranks(readings).select("meter_id", (F.col("rank") % workers).alias("shard"))
