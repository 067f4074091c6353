"""Column formulas of the meter domain."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Status limits, tolerance, sampling step and hour bands.
NOMINAL_VOLTS = (200, 240)
POWER_TOLERANCE = 0.05
HOURS_PER_READING = 0.5
NIGHT_HOURS = (0, 5)
MORNING_HOURS = (6, 9)
PEAK_HOURS = (17, 22)


def grid_status(nodes: Column, mean_volts: Column) -> Column:
    """OFFLINE without meters; an unknown mean voltage counts as UNSTABLE."""
    return (
        F.when(nodes == 0, "OFFLINE")
        .when(mean_volts.between(*NOMINAL_VOLTS), "NOMINAL")
        .otherwise("UNSTABLE")
    )


def ideal_power(volts: Column, amps: Column, power_factor: Column) -> Column:
    """Power in kW that follows from voltage, current and power factor."""
    return volts * amps * power_factor / F.lit(1000.0)


def load_band(event_time: Column) -> Column:
    hour = F.hour(event_time)
    return (
        F.when(hour.between(*NIGHT_HOURS), "night")
        .when(hour.between(*MORNING_HOURS), "morning")
        .when(hour.between(*PEAK_HOURS), "peak")
        .otherwise("day")
    )


def forecast_gap(actual: Column, predicted: Column) -> Column:
    return F.abs(actual - predicted)


def forecast_gap_percent(actual: Column, predicted: Column) -> Column:
    """Gap in percent of the actual value, 0 when that is not positive."""
    gap = forecast_gap(actual, predicted)
    return F.when(actual > 0, gap / actual * F.lit(100.0)).otherwise(F.lit(0.0))
