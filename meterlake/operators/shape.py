"""Shaping records: message <-> history row <-> reading. Works on batches and streams."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from meterlake import schemas

ISO_UTC_MILLIS = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
LOG_COLUMNS = ("event_time", "meter_id", "voltage", "power")


def align_history(df: DataFrame) -> DataFrame:
    """The 14 history columns in order and type.

    A column the input lacks gets its default; a NULL in a column it has stays NULL, and so
    does a value that cannot be converted.
    """
    columns = []
    for field in schemas.HISTORY:
        if field.name in df.columns:
            value = F.col(field.name).try_cast(field.dataType)
        else:
            value = F.lit(schemas.HISTORY_DEFAULTS[field.name]).cast(field.dataType)
        columns.append(value.alias(field.name))
    return df.select(*columns)


def readings_to_history(readings: DataFrame) -> DataFrame:
    """Readings under history names, aligned."""
    names = {column: "_".join(place) for column, place in schemas.PLACES.items()}
    names["event_time"] = "timestamp"
    return align_history(readings.withColumnsRenamed(names))


def nest_history(
    history: DataFrame,
    enabled_metrics: Collection[str] = tuple(schemas.METRICS),
    sent_at: Column | None = None,
) -> DataFrame:
    """History rows as nested records, with metrics not enabled set to NULL.

    `sent_at` replaces the row's own time, as a live sender would stamp it.
    """
    time = F.col("timestamp") if sent_at is None else sent_at

    def group(prefix: str) -> Column:
        fields = schemas.MESSAGE[prefix].dataType
        return F.struct(*(metric(prefix, f.name, f.dataType) for f in fields)).alias(prefix)

    def metric(prefix: str, name: str, kind) -> Column:
        if prefix == "measurements" and name not in enabled_metrics:
            return F.lit(None).cast(kind).alias(name)
        return F.col(f"{prefix}_{name}").alias(name)

    return history.select(
        "meter_id",
        F.date_format(time, ISO_UTC_MILLIS).alias("timestamp"),
        group("location"),
        group("measurements"),
        group("status"),
    )


def to_messages(records: DataFrame) -> DataFrame:
    """One JSON text per row in `value`; NULL fields become absent keys."""
    return records.select(F.to_json(F.struct("*")).alias("value"))


def decode_messages(messages: DataFrame, schema: StructType = schemas.MESSAGE) -> DataFrame:
    """Expand JSON in `value` (text or bytes); a broken message gives a row of NULLs.

    As a generator's output the fields cannot be pushed into later filters, where each use
    of a field would parse the message again.
    """
    record = F.from_json(F.col("value").cast("string"), schema)
    return messages.select(F.inline(F.array(record)))


def event_time() -> Column:
    """Time of a decoded message, NULL when the text is no timestamp."""
    return F.col("timestamp").try_cast("timestamp")


def placed(column: str) -> Column:
    """A lake column's value in a decoded message."""
    return F.col(".".join(schemas.PLACES[column]))


def flatten(decoded: DataFrame) -> DataFrame:
    """Decoded messages as flat readings."""
    return decoded.select(
        "meter_id",
        event_time().alias("event_time"),
        F.to_date(event_time()).alias("date"),
        *(placed(column).alias(column) for column in schemas.PLACES),
    )


def scoring_projection(decoded: DataFrame) -> DataFrame:
    """Decoded messages as model input, power under `actual_power`."""
    return decoded.select(
        "meter_id",
        event_time().alias("event_time"),
        *(placed(column).alias(column) for column in schemas.FEATURES),
        placed(schemas.LABEL).alias("actual_power"),
    )


def log_view(df: DataFrame) -> DataFrame:
    """Those log columns the input has."""
    return df.select(*(c for c in LOG_COLUMNS if c in df.columns))


def union_parts(first: DataFrame, *rest: DataFrame) -> DataFrame:
    """All rows of all parts, columns matched by name, absent ones NULL."""
    for part in rest:
        first = first.unionByName(part, allowMissingColumns=True)
    return first
