"""Fleet reports: overview, rankings, charts, consumption and forecast."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from meterlake.functions import measures, metering
from meterlake.operators import running


def latest_per_meter(readings: DataFrame, tie_break: tuple[str, ...] = ()) -> DataFrame:
    """The newest whole row of each meter; rows without a meter belong to none.

    Spark keeps one row per meter in each task before the shuffle, so a meter with very many
    rows is no larger than others after it.
    """
    newest_first = Window.partitionBy("meter_id").orderBy(*_newest_first(tie_break))
    return (
        readings.where(F.col("meter_id").isNotNull())
        .withColumn("_rank", F.row_number().over(newest_first))
        .where(F.col("_rank") == 1)
        .drop("_rank")
    )


def grid_overview(
    readings: DataFrame, digits: int | None = None, tie_break: tuple[str, ...] = ()
) -> DataFrame:
    """One row: meters, mean voltage, total load and status, from each meter's newest row."""
    nodes = F.count("*")
    volts = measures.mean(F.col("voltage"))
    return latest_per_meter(readings, tie_break).agg(
        nodes.alias("active_nodes"),
        F.when(nodes == 0, F.lit(0.0)).otherwise(volts).alias("avg_voltage"),
        measures.total(F.col("power"), digits).alias("total_load_kw"),
        metering.grid_status(nodes, volts).alias("grid_status"),
    )


def energy_by_meter(readings: DataFrame) -> DataFrame:
    """Counter state per meter, largest first, meters without one last."""
    return (
        readings.where(F.col("meter_id").isNotNull())
        .groupBy("meter_id")
        .agg(F.max(measures.without_nan(F.col("energy"))).alias("energy_kwh"))
        .orderBy(F.desc_nulls_last("energy_kwh"), "meter_id")
    )


def lake_summary(readings: DataFrame, digits: int | None = None) -> DataFrame:
    return readings.agg(
        F.count("*").alias("record_count"),
        measures.mean(F.col("power"), digits).alias("avg_power_kw"),
        F.max("event_time").alias("newest_event_time"),
    )


def newest_rows(df: DataFrame, rows: int, tie_break: tuple[str, ...] = ()) -> DataFrame:
    """Top rows by event_time, newest first."""
    return df.orderBy(*_newest_first(tie_break)).limit(rows)


def newest_rows_ascending(
    df: DataFrame, rows: int, tie_break: tuple[str, ...] = ()
) -> DataFrame:
    """The same rows in time order, for a chart."""
    return newest_rows(df, rows, tie_break).orderBy("event_time", *tie_break)


def voltage_points(
    readings: DataFrame, rows: int = 100, tie_break: tuple[str, ...] = ()
) -> DataFrame:
    """Voltages among the newest `rows` readings, one per meter and time."""
    recent = newest_rows(readings, rows, tie_break)
    order = F.struct(*tie_break, "voltage")
    return (
        recent.where(F.col("voltage").isNotNull())
        .groupBy("event_time", "meter_id")
        .agg(F.min_by("voltage", order).alias("voltage"))
    )


def voltage_pivot(
    readings: DataFrame,
    rows: int = 100,
    tie_break: tuple[str, ...] = (),
    meters: list[str] | None = None,
) -> DataFrame:
    """A row per time, a column per meter, over the newest `rows` readings.

    Without `meters` the columns are the meters of the points, `rows` at most.
    """
    points = voltage_points(readings, rows, tie_break)
    if meters is None:
        meters = sorted(row.meter_id for row in points.select("meter_id").distinct().collect())
    return points.groupBy("event_time").pivot("meter_id", meters).agg(F.first("voltage"))


def voltage_rows(
    readings: DataFrame, rows: int = 100, tie_break: tuple[str, ...] = ()
) -> DataFrame:
    """The pivot with the meters of a time in one JSON object, sorted by name."""
    wide = voltage_pivot(readings, rows, tie_break)
    meters = sorted(name for name in wide.columns if name != "event_time")
    volts = F.struct(*(F.col(f"`{name}`") for name in meters)) if meters else F.struct()
    return wide.select("event_time", F.to_json(volts).alias("voltages"))


def voltage_filled(
    readings: DataFrame, rows: int = 100, tie_break: tuple[str, ...] = ()
) -> DataFrame:
    """Voltage of every meter at every time among the newest `rows` readings.

    A gap takes the meter's voltage before it, at the start of the series the one after it.
    Points, times and meters number at most `rows` each, so one row can hold them.
    """
    cell = F.struct("event_time", "meter_id")
    points = voltage_points(readings, rows, tie_break).agg(
        F.collect_set("event_time").alias("times"),
        F.collect_set("meter_id").alias("meters"),
        F.map_from_entries(F.collect_list(F.struct(cell, "voltage"))).alias("known"),
    )
    grid = (
        points.select(F.explode("times").alias("event_time"), "meters", "known")
        .select("event_time", F.explode("meters").alias("meter_id"), "known")
        .select("event_time", "meter_id", F.try_element_at("known", cell).alias("voltage"))
    )
    by_time = Window.partitionBy("meter_id").orderBy("event_time")
    before = by_time.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    after = by_time.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    filled = F.coalesce(
        F.last("voltage", ignorenulls=True).over(before),
        F.first("voltage", ignorenulls=True).over(after),
    )
    return grid.select("event_time", "meter_id", filled.alias("voltage"))


def voltage_filled_all(
    readings: DataFrame, step: str = "hour", tie_break: tuple[str, ...] = ()
) -> DataFrame:
    """Voltage of every meter in every step of the whole table, from its first to its last.

    A step has the meter's first voltage in it. A gap takes the voltage before it, at the start
    of the series the one after it. Steps are fixed lengths: minute, hour or day.

    The voltages of a step are combined in each task, so that a meter has one row for each step
    at most; a row then makes the steps up to the meter's next one.
    """
    volts = measures.without_nan(F.col("voltage"))
    known = readings.where(
        volts.isNotNull() & F.col("meter_id").isNotNull() & F.col("event_time").isNotNull()
    ).withColumn("_step", F.date_trunc(step, "event_time"))
    points = known.groupBy("meter_id", "_step").agg(
        F.min_by(volts, F.struct("event_time", *tie_break)).alias("voltage")
    )
    by_time = Window.partitionBy("meter_id").orderBy("_step")
    length = F.expr(f"INTERVAL 1 {step}")
    ends = known.agg(F.min("_step").alias("first"), F.max("_step").alias("last"))
    kind = points.schema["_step"].dataType
    first = F.when(F.lag("_step").over(by_time).isNull(), ends.select("first").scalar())
    until = F.coalesce(F.lead("_step").over(by_time) - length, ends.select("last").scalar())
    return points.select(
        F.coalesce(first, "_step").cast(kind).alias("_from"),
        until.cast(kind).alias("_until"),
        "meter_id",
        "voltage",
    ).select(
        F.explode(F.sequence("_from", "_until", length)).alias("event_time"), "meter_id", "voltage"
    )


def forecast_error(predictions: DataFrame, tie_break: tuple[str, ...] = ()) -> DataFrame:
    """Gap between actual and predicted power in the newest prediction."""
    newest = F.max_by(
        F.struct("meter_id", "event_time", "actual_power", "predicted_power"),
        F.struct("event_time", *tie_break),
    )
    actual, predicted = F.col("actual_power"), F.col("predicted_power")
    return (
        predictions.agg(newest.alias("newest"))
        .where(F.col("newest").isNotNull())
        .select("newest.*")
        .select(
            "*",
            metering.forecast_gap(actual, predicted).alias("error_kw"),
            metering.forecast_gap_percent(actual, predicted).alias("error_pct"),
        )
    )


def power_residual(readings: DataFrame) -> DataFrame:
    """Measured power against the ideal one, and whether it is off by more than 5 %."""
    ideal = metering.ideal_power(F.col("voltage"), F.col("current"), F.col("power_factor"))
    gap = F.abs(F.col("power") - F.col("ideal_power"))
    return readings.select(
        "meter_id", "event_time", "power", ideal.alias("ideal_power")
    ).select(
        "*",
        gap.alias("gap_kw"),
        (gap > F.lit(metering.POWER_TOLERANCE) * F.col("ideal_power")).alias("out_of_tolerance"),
    )


def load_bands(readings: DataFrame, digits: int | None = None) -> DataFrame:
    """Readings and load by time of day."""
    return readings.groupBy(metering.load_band(F.col("event_time")).alias("band")).agg(
        F.count("*").alias("readings"),
        measures.mean(F.col("power"), digits).alias("avg_power_kw"),
        F.max(measures.without_nan(F.col("power"))).alias("max_power_kw"),
    )


def daily_units(readings: DataFrame, digits: int | None = None) -> DataFrame:
    """Summed power per meter and date, in the units of `measures.addend`."""
    return readings.groupBy("meter_id", "date").agg(
        F.sum(measures.addend(F.col("power"), digits)).alias("units")
    )


def consumption_rollup(
    readings: DataFrame,
    digits: int | None = None,
    hours: float = metering.HOURS_PER_READING,
) -> DataFrame:
    """Energy per meter and day, month and year. Months and years add up the days."""
    return (
        daily_units(readings, digits)
        .select("meter_id", "units", F.inline(_periods()))
        .groupBy("meter_id", "grain", "period_start")
        .agg(_energy(F.sum("units"), digits, hours).alias("energy_kwh"))
    )


def counter_rollup(
    readings: DataFrame,
    digits: int | None = None,
    tie_break: tuple[str, ...] = (),
    step: str = running.STEP,
) -> DataFrame:
    """Energy per meter and day, month and year from the counter, and how often it fell.

    A reading adds what the counter has gained since the meter's reading before it, on the
    reading's own date. A counter that falls was reset and started over from 0. Readings without
    a counter value are passed over; a meter's first value adds nothing.
    """
    value = measures.addend(F.col("energy"), digits)
    counted = running.value_before(readings, value, "_before", tie_break, step)
    gained = F.when(value < F.col("_before"), value).otherwise(value - F.col("_before"))
    daily = (
        counted.where(value.isNotNull())
        .groupBy("meter_id", "date")
        .agg(
            F.sum(gained).alias("units"),
            F.count_if(value < F.col("_before")).alias("resets"),
        )
    )
    return (
        daily.select("meter_id", "units", "resets", F.inline(_periods()))
        .groupBy("meter_id", "grain", "period_start")
        .agg(
            _energy(F.sum("units"), digits, 1.0).alias("energy_kwh"),
            F.sum("resets").alias("resets"),
        )
    )


def window_energy(
    readings: DataFrame,
    length: str = "3 days",
    digits: int | None = None,
    hours: float = metering.HOURS_PER_READING,
) -> DataFrame:
    """Energy per meter in tumbling windows, for batches and streams."""
    return window_units(readings, length, digits).select(
        "meter_id",
        "window_start",
        "window_end",
        "readings",
        _energy(F.col("units"), digits, hours).alias("energy_kwh"),
    )


def window_units(readings: DataFrame, length: str, digits: int | None = None) -> DataFrame:
    """Readings and summed power per meter and window, in the units of `measures.addend`."""
    return (
        readings.groupBy("meter_id", F.window("event_time", length))
        .agg(
            F.count("*").alias("readings"),
            F.sum(measures.addend(F.col("power"), digits)).alias("units"),
        )
        .select(
            "meter_id",
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "readings",
            "units",
        )
    )


def merged_units(partial: DataFrame) -> DataFrame:
    """Several `window_units` of the same windows as one."""
    return partial.groupBy("meter_id", "window_start", "window_end").agg(
        F.sum("readings").alias("readings"), F.sum("units").alias("units")
    )


def summed_windows(
    partial: DataFrame,
    digits: int | None = None,
    hours: float = metering.HOURS_PER_READING,
) -> DataFrame:
    """Energy per meter and window from several `window_units` of the same windows."""
    return merged_units(partial).select(
        "meter_id",
        "window_start",
        "window_end",
        "readings",
        _energy(F.col("units"), digits, hours).alias("energy_kwh"),
    )


def month_forecast(
    readings: DataFrame,
    digits: int | None = None,
    first_day: int = 3,
    hours: float = metering.HOURS_PER_READING,
) -> DataFrame:
    """Expected energy of the month per meter, for each date with readings.

    The month so far is scaled up to the length of the month, from its third day on. Works
    on daily sums, so a window holds 31 rows at most.
    """
    return forecast_of_days(daily_units(readings, digits), digits, first_day, hours)


def forecast_of_days(
    daily: DataFrame,
    digits: int | None = None,
    first_day: int = 3,
    hours: float = metering.HOURS_PER_READING,
) -> DataFrame:
    """The month forecast from `meter_id, date, units`, one row per meter and date."""
    month_so_far = (
        Window.partitionBy("meter_id", F.trunc("date", "month"))
        .orderBy("date")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    day = F.dayofmonth("date")
    return (
        daily.withColumn("so_far", _energy(F.sum("units").over(month_so_far), digits, hours))
        .where(day >= first_day)
        .select(
            "meter_id",
            "date",
            F.col("so_far").alias("month_to_date_kwh"),
            (F.col("so_far") * F.dayofmonth(F.last_day("date")) / day).alias("forecast_kwh"),
        )
    )


def _periods() -> Column:
    """The day, month and year of `date`."""
    return F.array(
        *(
            F.struct(
                F.lit(grain).alias("grain"),
                F.trunc("date", grain).alias("period_start")
                if grain != "day"
                else F.col("date").alias("period_start"),
            )
            for grain in ("day", "month", "year")
        )
    )


def _energy(units: Column, digits: int | None, hours: float) -> Column:
    return measures.from_sum(F.coalesce(units, F.lit(0)), digits, hours)


def _newest_first(tie_break: tuple[str, ...]) -> list[Column]:
    return [F.desc("event_time"), *(F.desc(c) for c in tie_break)]
