"""Streaming jobs. Each takes a stream of messages, from Kafka or from files.

Every query has its own checkpoint, so that each restarts where it stopped and two of them
can follow one topic. Late readings are kept: the jobs that only map and filter have no
watermark, and a reading goes to the partition of its own date.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable

from pyspark.errors import StreamingQueryException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.types import StructType

from meterlake import schemas
from meterlake.operators import alerts, clean, report, shape
from meterlake.plans import model as power_model
from meterlake.sources import runs

logger = logging.getLogger(__name__)

# Trigger intervals of the ingest and the scoring job.
INGEST_EVERY = {"processingTime": "1 minute"}
SCORE_EVERY = {"processingTime": "15 seconds"}
# For a run over what is there now.
ONCE = {"availableNow": True}

# Files that a micro-batch adds to a date at most.
FILES_PER_DATE = 8

# Time of the batch that brought a reading, while repeats are looked for.
ARRIVED = "arrived"


def cleaned_stream(messages: DataFrame) -> DataFrame:
    return clean.clean_readings(shape.flatten(shape.decode_messages(messages)))


def start_ingest(
    messages: DataFrame,
    lake_path: str,
    checkpoint: str,
    trigger: dict = INGEST_EVERY,
    files_per_date: int | None = FILES_PER_DATE,
    repeats_within: str | None = None,
) -> StreamingQuery:
    """Messages -> cleaned readings, appended to the lake by date.

    The readings are shuffled first, so that a batch adds no more than `files_per_date` files
    to a date. With None there is no shuffle, and each task writes a file per date it meets.
    With `repeats_within` such as "10 minutes" readings that repeat others are left out, see
    `without_repeats`; to switch this on or off takes a new checkpoint.
    """
    readings = cleaned_stream(messages)
    if repeats_within:
        readings = without_repeats(readings, repeats_within)
    if files_per_date:
        share = F.pmod(F.xxhash64("meter_id", "event_time"), F.lit(files_per_date))
        readings = readings.repartition("date", share)
    writer = _append(readings, "parquet", checkpoint, trigger)
    return writer.partitionBy("date").start(lake_path)


def without_repeats(readings: DataFrame, age: str) -> DataFrame:
    """The readings of a stream without those that repeat one in every column, as after a
    producer's retry.

    A reading is remembered for `age` after it has come, by the clock of the batches and not by
    its own time: late readings are kept, and the state is bounded by what arrives within `age`.
    A repeat that comes later passes; `clean.repeated_readings` counts those in the lake.
    """
    came = readings.withColumn(ARRIVED, F.current_timestamp()).withWatermark(ARRIVED, age)
    return came.dropDuplicatesWithinWatermark(readings.columns).drop(ARRIVED)


def repeats_left_out(query: StreamingQuery) -> int:
    """Readings that `without_repeats` left out of the batches Spark still reports on."""
    states = [state for batch in query.recentProgress for state in batch.stateOperators]
    return sum(state.customMetrics.get("numDroppedDuplicateRows", 0) for state in states)


def start_scoring(
    messages: DataFrame,
    model: PipelineModel,
    predictions_path: str,
    checkpoint: str,
    trigger: dict = SCORE_EVERY,
) -> StreamingQuery:
    """Messages -> predictions, appended as JSON by date, so that recent ones can be read
    without the rest."""
    decoded = shape.decode_messages(messages, schemas.SCORING_MESSAGE)
    predictions = power_model.score(model, shape.scoring_projection(decoded))
    dated = predictions.withColumn("date", F.to_date("event_time"))
    writer = _append(dated, "json", checkpoint, trigger)
    return writer.partitionBy("date").start(predictions_path)


def start_alerts(
    messages: DataFrame,
    rules: Iterable[alerts.AlertRule],
    alerts_path: str | None,
    checkpoint: str,
    trigger: dict = SCORE_EVERY,
    sink: Callable[[DataFrame], DataStreamWriter] | None = None,
) -> list[StreamingQuery]:
    """Messages -> alerts beside the readings, one query per rule.

    Each rule has its own checkpoint and, under `alerts_path`, its own folder, so a rule that
    fails while running stops no other. With `sink` the messages go there instead.
    """
    queries = []
    for number, rule in enumerate(rules):
        raised = shape.to_messages(alerts.run_rules(cleaned_stream(messages), [rule], strict=True))
        name = f"{number}-{rule.name}"
        writer = sink(raised) if sink else _append(raised, "text", checkpoint, trigger)
        writer = writer.option("checkpointLocation", f"{checkpoint}/{name}").trigger(**trigger)
        queries.append(writer.start() if sink else writer.start(f"{alerts_path}/{name}"))
    return queries


def wait_for_all(queries: Iterable[StreamingQuery]) -> list[StreamingQuery]:
    """Wait until every query has ended; those that failed are logged and returned.

    What a failed query wrote is not all there is: for a result take `finish_all`.
    """
    failed = []
    for query in queries:
        try:
            query.awaitTermination()
        except StreamingQueryException as error:
            logger.error("query %s failed: %s", query.id, error)
            failed.append(query)
    return failed


def finish_all(queries: Iterable[StreamingQuery]) -> None:
    """Wait until every query has ended, then raise the error of the first that failed."""
    for failed in wait_for_all(queries):
        raise failed.exception()


def read_alerts(spark: SparkSession, alerts_path: str) -> DataFrame:
    """Alert messages of all rules."""
    return spark.read.text(f"{alerts_path}/*")


def start_window_energy(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    length: str,
    digits: int | None = None,
    trigger: dict = INGEST_EVERY,
) -> StreamingQuery:
    """Messages -> energy per meter and window, complete after every micro-batch.

    Each batch adds its own partial sums as a run of the query, which its checkpoint names. A
    batch that runs again counts once; a query with a new checkpoint on the same path adds to
    what others wrote. Newer runs are merged as they come, so that their number grows with the
    logarithm of the windows. There is no state and no watermark: however late a reading is,
    it counts.
    """

    def add(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        owner = query_id(spark, checkpoint)
        table = runs.RunTable(spark, path)
        live = table.live(owner)
        if any(run.last >= number for run in live):
            return  # the same readings, counted before the query stopped
        new = table.write(report.window_units(batch, length, digits), number)
        if not new.rows:
            table.discard(new.name)
            return
        merged = runs.to_merge(live, new.rows)
        if merged:
            parts = table.read([*merged, new], window_partials(digits))
            whole = table.write(report.merged_units(parts), number)
            table.commit(owner, [whole], merged)
            table.discard(new.name)
        else:
            table.commit(owner, [new])

    writer = cleaned_stream(messages).writeStream.foreachBatch(add)
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The identity that Spark gives to a checkpoint and to every query that goes on with it."""
    found = spark.read.schema("id string").json(f"{checkpoint}/metadata").first()
    return found.id


def read_window_energy(
    spark: SparkSession, path: str, digits: int | None = None
) -> DataFrame:
    """The windows that all queries of `start_window_energy` on this path have written, partial
    sums added up; no rows before the first batch."""
    table = runs.RunTable(spark, path)
    return report.summed_windows(table.read(table.live(), window_partials(digits)), digits)


def read_month_forecast(
    spark: SparkSession, path: str, digits: int | None = None
) -> DataFrame:
    """The month forecast from the days that `start_window_energy` has added up, with `length`
    "1 day": up to date after every micro-batch, late readings of any day included."""
    table = runs.RunTable(spark, path)
    days = report.merged_units(table.read(table.live(), window_partials(digits)))
    dated = days.withColumn("date", F.to_date("window_start"))
    return report.forecast_of_days(dated.select("meter_id", "date", "units"), digits)


def window_partials(digits: int | None) -> StructType:
    """What a run of window sums holds: whole units if there are digits."""
    units = schemas.DOUBLE if digits is None else schemas.LONG
    return schemas.record(
        meter_id=schemas.STRING,
        window_start=schemas.TIMESTAMP,
        window_end=schemas.TIMESTAMP,
        readings=schemas.LONG,
        units=units,
    )


def start_closed_windows(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    length: str,
    lateness: str,
    digits: int | None = None,
    trigger: dict = INGEST_EVERY,
) -> StreamingQuery:
    """Messages -> energy per meter and window, each written once and final.

    A window is written when the watermark has passed it; the newest windows are still open,
    and a reading later than `lateness` is not counted. `start_window_energy` counts all.
    """
    readings = cleaned_stream(messages).withWatermark("event_time", lateness)
    windows = report.window_energy(readings, length, digits)
    return _append(windows, "parquet", checkpoint, trigger).start(path)


def _append(rows: DataFrame, sink: str, checkpoint: str, trigger: dict) -> DataStreamWriter:
    return (
        rows.writeStream.outputMode("append")
        .format(sink)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
    )
