"""The `events` table read as meter readings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from meterlake.operators import clean, running

# Districts in the order of user_id % 10.
DISTRICTS = (
    "Camden", "Westminster", "Greenwich", "Hackney", "Islington",
    "Chelsea", "Kensington", "Hammersmith", "Fulham", "Brixton",
)

# Power is a multiple of 0.0001 kW.
DIGITS = 4
COUNTER_START_KWH = 1000.0
TIE_BREAK = ("event_id",)


def events_path(sf_dir: str) -> str:
    return f"{sf_dir}/events.parquet"


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The session zone must be UTC: messages carry UTC times and dates come from them."""
    return spark.read.parquet(events_path(sf_dir))


def readings(events: DataFrame) -> DataFrame:
    """Readings without the energy counter."""
    district = F.element_at(
        F.array(*(F.lit(d) for d in DISTRICTS)), (F.col("user_id") % 10 + 1).cast("int")
    )
    voltage = (
        F.when(F.col("event_type") == "signup", F.lit(None).cast("double"))
        .when(F.col("event_id") % 97 == 0, F.lit(0.0))
        .otherwise(F.lit(200.0) + F.col("k") * F.lit(0.5))
    )
    units = F.expr(
        "CASE WHEN event_id % 89 = 0 THEN -10000L ELSE "
        "(209L * CAST(rint(value * 100) AS BIGINT) * (95L + event_id % 11)) div 1000L END"
    )
    # A generator, so that filters on the voltage do not parse the text again.
    parsed = events.select("*", F.inline(F.array(F.from_json("props", "k INT"))))
    return parsed.select(
        "event_id",
        F.concat(F.lit("LCL-"), F.lpad(F.col("user_id").cast("string"), 4, "0")).alias("meter_id"),
        F.col("ts").alias("event_time"),
        F.col("ts").cast("date").alias("date"),
        district.alias("district"),
        voltage.alias("voltage"),
        F.col("value").alias("current"),
        (units.cast("double") / F.lit(10.0**DIGITS)).alias("power"),
        F.lit(0.95).alias("power_factor"),
        ((F.col("event_id") % 5 + 4998).cast("double") / F.lit(100.0)).alias("frequency"),
        F.when(F.col("event_type") == "error", 1).otherwise(0).alias("status_code"),
    )


def raw_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readings(read_events(spark, sf_dir))


def raw_with_energy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings with the counter, which stands still at negative power."""
    raw = raw_readings(spark, sf_dir)
    measured = raw.withColumn("measured", F.col("power"))
    counted = running.running_energy(
        measured.withColumn("power", F.greatest("power", F.lit(0.0))),
        digits=DIGITS,
        tie_break=TIE_BREAK,
    )
    return counted.select(
        *(F.col("measured").alias("power") if c == "power" else F.col(c) for c in raw.columns),
        (F.lit(COUNTER_START_KWH) + F.col("energy_kwh")).alias("energy"),
    )


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.clean_readings(raw_readings(spark, sf_dir))


def cleaned_with_energy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.clean_readings(raw_with_energy(spark, sf_dir))
