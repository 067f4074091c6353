"""Kafka topics of readings and alerts. Needs the spark-sql-kafka package on the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter

# Topic names.
READINGS_TOPIC = "smart-meter-data"
ALERTS_TOPIC = "plugins-data"


def source_options(
    servers: str,
    topic: str = READINGS_TOPIC,
    starting_offsets: str | None = None,
    max_offsets: int | None = None,
    max_records_per_task: int | None = None,
) -> dict[str, str]:
    """Without `starting_offsets` a new query starts at the end of the topic.

    `max_offsets` bounds a micro-batch, so that a backlog is not one single batch, and
    `max_records_per_task` splits a large topic partition among tasks.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "failOnDataLoss": "false",
        "startingOffsets": starting_offsets,
        "maxOffsetsPerTrigger": max_offsets,
        "maxRecordsPerPartition": max_records_per_task,
    }
    return {name: str(value) for name, value in options.items() if value is not None}


def sink_options(servers: str, topic: str) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": servers,
        "topic": topic,
        "kafka.acks": "all",
        "kafka.retries": "3",
    }


def read_topic(
    spark: SparkSession,
    servers: str,
    topic: str = READINGS_TOPIC,
    starting_offsets: str | None = None,
    max_offsets: int | None = None,
    max_records_per_task: int | None = None,
) -> DataFrame:
    options = source_options(
        servers, topic, starting_offsets, max_offsets, max_records_per_task
    )
    return spark.readStream.format("kafka").options(**options).load()


def write_topic(messages: DataFrame, servers: str, topic: str) -> None:
    """Publish a batch of messages, JSON in `value`."""
    messages.write.format("kafka").options(**sink_options(servers, topic)).save()


def stream_to_topic(messages: DataFrame, servers: str, topic: str) -> DataStreamWriter:
    """Publish a stream of messages, JSON in `value`."""
    return messages.writeStream.format("kafka").options(**sink_options(servers, topic))
