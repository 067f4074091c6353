"""Running totals per meter that do not need a meter to fit into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from meterlake.functions import measures, metering

# Every meter is summed in steps of this length; a step of one meter fits into a task.
STEP = "hour"
# The step of rows without a time, before all others.
NO_TIME = -(2**63)
# Rounds of a replay that one row makes at a time.
ROUNDS = 4096


def running_total(
    df: DataFrame,
    value: Column,
    name: str,
    tie_break: tuple[str, ...] = (),
    step: str = STEP,
) -> DataFrame:
    """Add `name`: the sum of `value` over the meter's rows up to this one, by event_time.

    Rows without a meter have no such sum and are left out; rows without a time come first.
    `value` must add up exactly (integers or decimals), so that the step cannot change a sum.

    All meters take one path, whatever their size: totals per step are combined in each task,
    a window over them gives what is carried into a step, and a window inside the step adds
    its rows.
    """
    # A number, never NULL: where rows and sums meet by plain equality, the join leaves the rows
    # where the window inside the step needs them, and they are shuffled once.
    step_start = F.unix_micros(F.date_trunc(step, "event_time"))
    rows = df.where(F.col("meter_id").isNotNull()).withColumn(
        "_step", F.coalesce(step_start, F.lit(NO_TIME))
    )
    earlier = (
        Window.partitionBy("meter_id")
        .orderBy("_step")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = (
        rows.groupBy("meter_id", "_step")
        .agg(F.sum(value).alias("_step_total"))
        .select(
            F.col("meter_id").alias("_carry_meter"),
            F.col("_step").alias("_carry_step"),
            F.sum("_step_total").over(earlier).alias("_carried"),
        )
    )
    so_far = (
        Window.partitionBy("meter_id", "_step")
        .orderBy("event_time", *tie_break)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    zero = F.lit(0)
    return (
        rows.join(
            carried,
            (F.col("meter_id") == F.col("_carry_meter"))
            & (F.col("_step") == F.col("_carry_step")),
        )
        .withColumn(
            name, F.coalesce(F.sum(value).over(so_far), zero) + F.coalesce("_carried", zero)
        )
        .select(*df.columns, name)
    )


def value_before(
    df: DataFrame,
    value: Column,
    name: str,
    tie_break: tuple[str, ...] = (),
    step: str = STEP,
) -> DataFrame:
    """Add `name`: the meter's last `value` that is not NULL in a row before this one.

    Rows without a meter are left out; rows without a time come first. As in `running_total`,
    the last value of a step is picked in each task, a window over the steps carries it on, and
    a window inside a step looks at its own rows, so that no meter needs one task.
    """
    rows = df.where(F.col("meter_id").isNotNull()).withColumns(
        {"_step": F.date_trunc(step, "event_time"), "_value": value}
    )
    order = F.struct("event_time", *tie_break)
    earlier = (
        Window.partitionBy("meter_id")
        .orderBy("_step")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    # Steps without a value carry on what is before them.
    steps = rows.groupBy("meter_id", "_step").agg(
        F.max_by("_value", F.when(F.col("_value").isNotNull(), order)).alias("_last")
    )
    carried = steps.select(
        F.col("meter_id").alias("_carry_meter"),
        F.col("_step").alias("_carry_step"),
        F.last("_last", ignorenulls=True).over(earlier).alias("_carried"),
    )
    inside = (
        Window.partitionBy("meter_id", "_step")
        .orderBy("event_time", *tie_break)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        rows.join(
            carried,
            (F.col("meter_id") == F.col("_carry_meter"))
            & F.col("_step").eqNullSafe(F.col("_carry_step")),
        )
        .withColumn(
            name, F.coalesce(F.last("_value", ignorenulls=True).over(inside), "_carried")
        )
        .select(*df.columns, name)
    )


def running_energy(
    readings: DataFrame,
    digits: int,
    name: str = "energy_kwh",
    hours: float = metering.HOURS_PER_READING,
    tie_break: tuple[str, ...] = (),
    step: str = STEP,
) -> DataFrame:
    """Add the energy a meter has counted so far, each reading standing for `hours`.

    Power is added in whole units of 10^-digits, which is exact.
    """
    power = measures.whole_units(F.col("power"), digits)
    summed = running_total(readings, power, "_power_so_far", tie_break, step)
    energy = measures.from_sum(F.col("_power_so_far"), digits, hours)
    return summed.withColumn(name, energy).drop("_power_so_far")


def row_positions(
    df: DataFrame, tie_break: tuple[str, ...] = (), step: str = STEP
) -> DataFrame:
    """Add `position`: the row's place in its meter's history, from 0."""
    counted = running_total(df, F.lit(1), "_nth", tie_break, step)
    return counted.withColumn("position", F.col("_nth") - 1).drop("_nth")


def replay_schedule(
    df: DataFrame,
    first_tick: int,
    end_tick: int,
    tie_break: tuple[str, ...] = (),
    step: str = STEP,
) -> DataFrame:
    """What each meter sends at the ticks from `first_tick` up to, not including, `end_tick`.

    A meter sends its rows in time order and starts over after the last one: a round. A row is
    repeated for the rounds in which the span holds its place, and left out if there is none,
    so that what is made is what is sent. An empty span has no rows, nor has a time before
    tick 0; rows without a meter are left out.
    """
    placed = row_positions(df, tie_break, step)
    lengths = (
        df.where(F.col("meter_id").isNotNull())
        .groupBy("meter_id")
        .agg(F.count("*").alias("_length"))
    )
    first, end = max(first_tick, 0), max(end_tick, 0)
    # Rounds r with first <= position + r * length < end.
    low = F.greatest(F.lit(0), F.expr(f"({first}L - position + _length - 1) div _length"))
    high = F.expr(f"CASE WHEN position < {end}L THEN ({end}L - position - 1) div _length ELSE -1 END")
    # A short meter may need more rounds than an array of one row should hold.
    blocks = F.sequence(F.expr(f"_low div {ROUNDS}"), F.expr(f"_high div {ROUNDS}"))
    from_round = F.greatest("_low", F.col("_block") * ROUNDS)
    to_round = F.least("_high", F.col("_block") * ROUNDS + ROUNDS - 1)
    lengths = lengths.withColumnRenamed("meter_id", "_meter")
    return (
        placed.join(lengths, F.col("meter_id") == F.col("_meter"))
        .withColumns({"_low": low, "_high": high})
        .where("_low <= _high")
        .withColumn("_block", F.explode(blocks))
        .withColumn("_round", F.explode(F.sequence(from_round, to_round)))
        .withColumn("tick", F.col("position") + F.col("_round") * F.col("_length"))
        .select("meter_id", "position", "tick", *(c for c in df.columns if c != "meter_id"))
    )


def stamped(
    history: DataFrame,
    start: Column,
    interval_seconds: float,
    tie_break: tuple[str, ...] = (),
    step: str = STEP,
) -> DataFrame:
    """History rows with the time at which a sender that starts at `start` would send them.

    A meter sends one row per interval, in time order, so its times stay different.
    """
    placed = row_positions(history.withColumn("event_time", F.col("timestamp")), tie_break, step)
    millis = (F.col("position") * F.lit(interval_seconds * 1000)).cast("long")
    sent = F.timestamp_millis(F.unix_millis(start) + millis)
    return placed.withColumn("timestamp", sent).select(*history.columns)
