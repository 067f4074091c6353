"""Every operator as a query over the given tables."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from meterlake import schemas, sinks
from meterlake.operators import alerts, clean, fleet, report, running, sampling, shape
from meterlake.plans import fixture, model as power_model, moments
from meterlake.session import scratch_path
from meterlake.sources import files, runs
from meterlake.streaming import jobs

DIGITS, TIE_BREAK = fixture.DIGITS, fixture.TIE_BREAK
LAKE_ORDER = ("meter_id",)
# At least so many files of messages; one task reads a file, so more messages make more files.
MESSAGE_FILES, MESSAGES_PER_FILE = 8, 250_000
SENT_FROM, SENT_EVERY = "2024-02-01 00:00:00", 2
PREDICTION_DIGITS = 3
# Counters are multiples of 0.00005 kWh.
COUNTER_DIGITS = 5
COUNTER_UNITS, COUNTER_END = 10**COUNTER_DIGITS, 50 * 10**COUNTER_DIGITS

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    """Register under the function's name, with zone-free times in the result."""

    @functools.wraps(build)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        result = build(spark, sf_dir)
        return result.withColumns(
            {
                name: F.col(name).cast("timestamp_ntz")
                for name, kind in result.dtypes
                if kind == "timestamp"
            }
        )

    QUERIES[build.__name__] = run
    return run


def per_session(build: Callable) -> Callable:
    """Build once per Spark application, data folder and state of its files."""
    built = {}

    @functools.wraps(build)
    def lookup(spark: SparkSession, sf_dir: str):
        files_now = fixture.read_events(spark, sf_dir).select(
            "_metadata.file_path", "_metadata.file_modification_time"
        )
        state = frozenset(map(tuple, files_now.distinct().collect()))
        key = (spark.sparkContext.applicationId, sf_dir, state)
        if key not in built:
            built[key] = build(spark, sf_dir)
        return built[key]

    return lookup


# --- shared inputs


@per_session
def lake_path(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "lake")
    sinks.write_lake(lake_columns(fixture.cleaned_with_energy(spark, sf_dir)), path)
    return path


def lake_columns(readings: DataFrame) -> DataFrame:
    return zoned(readings).select(*schemas.READING.names)


def zoned(df: DataFrame) -> DataFrame:
    """Event times of `events` carry no zone; files hold them as UTC."""
    return df.withColumn("event_time", F.col("event_time").cast("timestamp"))


def lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.read_lake(spark, lake_path(spark, sf_dir))


@per_session
def model(spark: SparkSession, sf_dir: str) -> PipelineModel:
    return power_model.train(fixture.cleaned(spark, sf_dir))


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture.cleaned(spark, sf_dir).select(
        "meter_id", "event_time", "voltage", "current", "power_factor", "frequency",
        F.col("power").alias("actual_power"),
    )


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return presented(power_model.score(model(spark, sf_dir), features(spark, sf_dir)))


def presented(scored: DataFrame) -> DataFrame:
    return scored.withColumn("predicted_power", F.round("predicted_power", PREDICTION_DIGITS))


def nested(readings: DataFrame, metrics: list[str]) -> DataFrame:
    return shape.nest_history(shape.readings_to_history(readings), metrics)


@per_session
def messages_path(spark: SparkSession, sf_dir: str) -> str:
    """All readings with their counter as messages, in compressed files that stand in for a topic.

    The readings are dealt out to the files before they become texts, which are longer.
    """
    path = scratch_path(spark, "messages")
    number = -(-fixture.read_events(spark, sf_dir).count() // MESSAGES_PER_FILE)
    dealt = fixture.raw_with_energy(spark, sf_dir).repartition(
        max(number, MESSAGE_FILES), "meter_id", "event_time"
    )
    sent = shape.to_messages(nested(dealt, schemas.METRICS))
    sent.write.text(path, compression="gzip")
    return path


def message_stream(spark: SparkSession, sf_dir: str, batches: int = 1) -> DataFrame:
    path = messages_path(spark, sf_dir)
    number = len(spark.read.text(path).inputFiles())
    reader = spark.readStream.option("maxFilesPerTrigger", max(-(-number // batches), 1))
    return reader.text(path)


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.text(messages_path(spark, sf_dir))


def finish(start: Callable, spark: SparkSession, label: str) -> str:
    """Run a streaming job over what there is now; the folder it wrote."""
    out = scratch_path(spark, label)
    start(out, scratch_path(spark, f"{label}-checkpoint")).awaitTermination()
    return out


# --- sources and sinks


@query
def lake_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lake(spark, sf_dir)


@query
def lake_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lake(spark, sf_dir).agg(F.count("*").alias("record_count"))


@query
def latest_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.read_latest_partition(spark, lake_path(spark, sf_dir))


@query
def compacted_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, target = lake_path(spark, sf_dir), scratch_path(spark, "compacted")
    newest = files.newest_date(lake(spark, sf_dir))
    for _ in range(2):  # as a job that runs again
        sinks.compact_lake(spark, source, target, newest)
    table = runs.RunTable(spark, target)
    return table.read(table.live(), schemas.READING)


@query
def compacted_lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole lake, compacted but for a third of its readings, which come later: the dates
    hold files on either side, and the newest date is compacted once more."""
    source, target = scratch_path(spark, "late-lake"), scratch_path(spark, "compacted")
    late = F.pmod(F.xxhash64("meter_id", "event_time"), F.lit(3)) == 0
    sinks.write_lake(lake(spark, sf_dir).where(~late), source)
    sinks.compact_lake(spark, source, target)
    sinks.write_lake(lake(spark, sf_dir).where(late), source)
    newest = files.newest_date(lake(spark, sf_dir))
    sinks.compact_lake(spark, source, target, newest)
    return files.read_compacted_lake(spark, source, target)


@query
def predictions_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "predictions")
    sinks.write_predictions(zoned(predictions(spark, sf_dir)), path)
    return files.read_predictions(spark, path)


@query
def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "history")
    sinks.write_history(
        shape.readings_to_history(fixture.raw_with_energy(spark, sf_dir)), path
    )
    return files.read_history(spark, path)


# --- shaping


@query
def json_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shape.to_messages(
        nested(fixture.cleaned_with_energy(spark, sf_dir), schemas.METRICS)
    )


@query
def json_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = shape.decode_messages(messages(spark, sf_dir))
    return decoded.select("meter_id", "timestamp", "location.*", "measurements.*", "status.*")


@query
def json_decode_narrow(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = shape.decode_messages(messages(spark, sf_dir), schemas.SCORING_MESSAGE)
    return decoded.select("meter_id", "timestamp", "measurements.*")


@query
def flatten_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shape.flatten(shape.decode_messages(messages(spark, sf_dir)))


@query
def metric_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    sent = nested(fixture.raw_readings(spark, sf_dir), ["voltage_v", "active_power_kw"])
    decoded = shape.decode_messages(shape.to_messages(sent))
    return decoded.select("meter_id", "timestamp", "measurements.*")


@query
def schema_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Battery level comes as text, location, energy and message not at all."""
    raw = fixture.raw_readings(spark, sf_dir)
    return shape.readings_to_history(
        raw.drop("district").withColumn("status_battery_level", F.expr("'7' || status_code"))
    )


@query
def union_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings without a fault, and those with one from a sender that knows no district."""
    rows = fixture.cleaned(spark, sf_dir).drop("event_id")
    return shape.union_parts(
        rows.where("status_code = 0"), rows.where("status_code <> 0").drop("district")
    )


# --- filters


@query
def clean_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture.cleaned(spark, sf_dir).drop("event_id")


@query
def scoring_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = shape.decode_messages(messages(spark, sf_dir), schemas.SCORING_MESSAGE)
    return clean.scoring_rows(shape.scoring_projection(decoded))


@query
def training_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.training_rows(fixture.cleaned(spark, sf_dir))


@query
def meter_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fixture.cleaned(spark, sf_dir)
    return clean.only_meters(rows, F.broadcast(fleet.first_meters(rows))).drop("event_id")


@query
def distinct_meters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fleet.distinct_meters(fixture.cleaned(spark, sf_dir))


@query
def meter_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fleet.meter_shards(fixture.cleaned(spark, sf_dir), workers=5)


@query
def sample_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fixture.cleaned(spark, sf_dir)
    return sampling.sample_readings(rows, percent=10).drop("event_id")


@query
def sample_per_meter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fifty readings of a meter: more than some have, fewer than others."""
    rows = fixture.cleaned(spark, sf_dir)
    return sampling.sample_per_meter(rows, 50, TIE_BREAK).drop("event_id")


# --- reports


@query
def latest_per_meter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.latest_per_meter(fixture.cleaned(spark, sf_dir), TIE_BREAK)


@query
def grid_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.grid_overview(fixture.cleaned(spark, sf_dir), DIGITS, TIE_BREAK)


@query
def energy_by_meter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.energy_by_meter(fixture.cleaned_with_energy(spark, sf_dir))


@query
def lake_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.lake_summary(fixture.cleaned(spark, sf_dir), DIGITS)


@query
def lake_top500(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.newest_rows(lake(spark, sf_dir), 500, LAKE_ORDER)


@query
def recent_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shape.log_view(report.newest_rows(lake(spark, sf_dir), 10, LAKE_ORDER))


@query
def voltage_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.voltage_rows(fixture.cleaned(spark, sf_dir), tie_break=TIE_BREAK)


@query
def voltage_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.voltage_filled(fixture.cleaned(spark, sf_dir), tie_break=TIE_BREAK)


@query
def voltage_filled_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.voltage_filled_all(fixture.cleaned(spark, sf_dir), "hour", TIE_BREAK)


@query
def load_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.load_bands(fixture.cleaned(spark, sf_dir), DIGITS)


@query
def power_residual(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.power_residual(fixture.cleaned(spark, sf_dir))


@query
def consumption_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.consumption_rollup(fixture.cleaned(spark, sf_dir), DIGITS)


@query
def counter_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters that start over at every 50 kWh; readings without a voltage have none."""
    rows = fixture.cleaned_with_energy(spark, sf_dir)
    units = F.rint(F.col("energy") * COUNTER_UNITS).cast("long") % COUNTER_END
    register = F.when(F.col("voltage").isNotNull(), units / F.lit(float(COUNTER_UNITS)))
    return report.counter_rollup(rows.withColumn("energy", register), COUNTER_DIGITS, TIE_BREAK)


@query
def window_3d(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.window_energy(fixture.cleaned(spark, sf_dir), "3 days", DIGITS)


@query
def month_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.month_forecast(fixture.cleaned(spark, sf_dir), DIGITS)


@query
def running_energy(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = running.running_energy(
        fixture.cleaned(spark, sf_dir), digits=DIGITS, tie_break=TIE_BREAK
    )
    return counted.select("meter_id", "event_time", "power", "energy_kwh")


@query
def replay_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Until the longest meter has sent all its rows; most meters start over before."""
    rows = fixture.cleaned(spark, sf_dir)
    end = rows.groupBy("meter_id").count().agg(F.max("count")).first()[0] or 0
    return running.replay_schedule(rows, 0, end, TIE_BREAK).select(
        "meter_id", "tick", "position", "event_time", "voltage", "power"
    )


@query
def published_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The readings as a sender would stamp them, one per meter every two seconds."""
    history = shape.readings_to_history(fixture.raw_readings(spark, sf_dir))
    start = F.lit(SENT_FROM).cast("timestamp")
    sent = shape.nest_history(running.stamped(history, start, SENT_EVERY))
    decoded = shape.decode_messages(shape.to_messages(sent))
    return decoded.select("meter_id", "timestamp", "measurements.current_a")


# --- alerts


class UnknownSensor(alerts.AlertRule):
    """Refers to a column readings do not have."""

    def alert(self, readings: DataFrame) -> Column:
        return F.when(readings["gas_pressure"] > 0, F.lit(None))


class HighOverVoltage(alerts.OverVoltage):
    def __init__(self):
        super().__init__(limit_volts=245)


@query
def overvoltage_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alerts.run_rules(fixture.cleaned(spark, sf_dir), [alerts.OverVoltage()])


@query
def alert_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [UnknownSensor(), alerts.OverVoltage(), HighOverVoltage()]
    return alerts.run_rules(fixture.cleaned(spark, sf_dir), rules)


class PowerPerVolt(alerts.AlertRule):
    """Power per volt off the nominal 230; it forgets that the voltage may be 230."""

    def alert(self, readings: DataFrame) -> Column:
        steep = readings["power"] / (readings["voltage"] - 230) > 1
        texts = {"type": "WARNING", "message": "Steep", "action": "Inspect"}
        return F.when(steep, F.struct(*(F.lit(text).alias(name) for name, text in texts.items())))


@query
def alerts_beside_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rule divides by zero on some readings; it goes on, and the other one too."""
    rules = [PowerPerVolt(), alerts.OverVoltage()]
    return alerts.run_rules(fixture.cleaned(spark, sf_dir), rules)


@query
def rule_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [PowerPerVolt(), alerts.OverVoltage()]
    return alerts.rule_failures(fixture.cleaned(spark, sf_dir), rules)


# --- model


@query
def train_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = power_model.train_report(model(spark, sf_dir), fixture.cleaned(spark, sf_dir))
    return rows.withColumn("value", F.round("value", 4))


@query
def train_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The model from sums that were kept while the lake grew, late readings included."""
    source, target = scratch_path(spark, "growing-lake"), scratch_path(spark, "moments")
    late = F.pmod(F.xxhash64("meter_id", "event_time"), F.lit(3)) == 0
    for part in (~late, late):
        sinks.write_lake(lake(spark, sf_dir).where(part), source)
        moments.update(spark, source, target)
    fitted = moments.fit(spark, target)
    rows = power_model.train_report(fitted, fixture.cleaned(spark, sf_dir))
    return rows.withColumn("value", F.round("value", 4))


@query
def score_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predictions(spark, sf_dir)


@query
def recent_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions of the hour before the newest one."""
    rows = predictions(spark, sf_dir)
    as_of = features(spark, sf_dir).dropna("any").select(F.max("event_time")).scalar()
    return report.newest_rows(clean.since(rows, as_of), 500, LAKE_ORDER)


@query
def forecast_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.newest_rows_ascending(predictions(spark, sf_dir), 60, LAKE_ORDER)


@query
def forecast_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.forecast_error(predictions(spark, sf_dir), LAKE_ORDER)


# --- streams


@query
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    sent = message_stream(spark, sf_dir)
    out = finish(lambda *to: jobs.start_ingest(sent, *to, jobs.ONCE), spark, "ingest")
    return files.read_lake(spark, out)


@query
def stream_ingest_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message is sent twice, as a producer may that got no answer."""
    sent = message_stream(spark, sf_dir, 2).union(message_stream(spark, sf_dir))
    out = finish(
        lambda *to: jobs.start_ingest(sent, *to, jobs.ONCE, repeats_within="1 hour"),
        spark,
        "ingest-once",
    )
    return files.read_lake(spark, out)


@query
def repeated_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The readings that a second delivery of a third of the lake repeats."""
    rows = lake(spark, sf_dir)
    again = rows.where("status_code = 1")
    return clean.repeated_readings(shape.union_parts(rows, again))


@query
def stream_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    sent, fitted = message_stream(spark, sf_dir), model(spark, sf_dir)
    out = finish(lambda *to: jobs.start_scoring(sent, fitted, *to, jobs.ONCE), spark, "predict")
    return presented(files.read_predictions(spark, out))


@query
def stream_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    sent, rules = message_stream(spark, sf_dir), [alerts.OverVoltage()]
    out = scratch_path(spark, "alerts")
    jobs.finish_all(
        jobs.start_alerts(sent, rules, out, scratch_path(spark, "alerts-checkpoint"), jobs.ONCE)
    )
    return shape.decode_messages(jobs.read_alerts(spark, out), schemas.ALERT)


@query
def stream_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two queries on one path, each with its own checkpoint and its share of the messages; the
    second one reads in several batches."""
    out = scratch_path(spark, "windows")
    for share in (0, 1):
        sent = message_stream(spark, sf_dir, share + 1)
        own = F.pmod(F.xxhash64("value"), F.lit(2)) == share
        jobs.start_window_energy(
            sent.where(own), out, scratch_path(spark, "windows-checkpoint"), "1 hour", DIGITS,
            jobs.ONCE,
        ).awaitTermination()
    return jobs.read_window_energy(spark, out, DIGITS)


@query
def stream_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The month forecast from a stream in several batches, whose readings come in no order."""
    sent = message_stream(spark, sf_dir, 2)
    out = finish(
        lambda *to: jobs.start_window_energy(
            sent, *to, length="1 day", digits=DIGITS, trigger=jobs.ONCE
        ),
        spark,
        "days",
    )
    return jobs.read_month_forecast(spark, out, DIGITS)
