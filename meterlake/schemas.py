"""Record layouts. Every field is nullable: a switched-off metric is an absent key."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructType,
    TimestampType,
)

STRING, DOUBLE, INT, LONG = StringType(), DoubleType(), IntegerType(), LongType()
BOOLEAN = BooleanType()
TIMESTAMP, DATE = TimestampType(), DateType()


def record(**fields: DataType) -> StructType:
    schema = StructType()
    for name, kind in fields.items():
        schema.add(name, kind)
    return schema


# Names and types of the wire and lake formats.

MESSAGE = record(
    meter_id=STRING,
    timestamp=STRING,
    location=record(city=STRING, district=STRING, gps=STRING),
    measurements=record(
        voltage_v=DOUBLE,
        current_a=DOUBLE,
        active_power_kw=DOUBLE,
        power_factor=DOUBLE,
        frequency_hz=DOUBLE,
        total_energy_kwh=DOUBLE,
    ),
    status=record(code=INT, message=STRING, battery_level=INT),
)

SCORING_MESSAGE = record(
    meter_id=STRING,
    timestamp=STRING,
    measurements=record(
        voltage_v=DOUBLE,
        current_a=DOUBLE,
        power_factor=DOUBLE,
        frequency_hz=DOUBLE,
        active_power_kw=DOUBLE,
    ),
)

READING = record(
    meter_id=STRING,
    event_time=TIMESTAMP,
    date=DATE,
    district=STRING,
    voltage=DOUBLE,
    current=DOUBLE,
    power=DOUBLE,
    power_factor=DOUBLE,
    frequency=DOUBLE,
    energy=DOUBLE,
    status_code=INT,
)

PREDICTION = record(
    meter_id=STRING, event_time=TIMESTAMP, actual_power=DOUBLE, predicted_power=DOUBLE
)

ALERT = record(
    meter_id=STRING,
    event_time=TIMESTAMP,
    rule=STRING,
    type=STRING,
    message=STRING,
    action=STRING,
)

HISTORY = record(
    meter_id=STRING,
    timestamp=TIMESTAMP,
    location_city=STRING,
    location_district=STRING,
    location_gps=STRING,
    measurements_voltage_v=DOUBLE,
    measurements_current_a=DOUBLE,
    measurements_active_power_kw=DOUBLE,
    measurements_power_factor=DOUBLE,
    measurements_frequency_hz=DOUBLE,
    measurements_total_energy_kwh=DOUBLE,
    status_code=INT,
    status_message=STRING,
    status_battery_level=INT,
)

# Where a lake column stands in a message. A history column is named after both.
PLACES = {
    "district": ("location", "district"),
    "voltage": ("measurements", "voltage_v"),
    "current": ("measurements", "current_a"),
    "power": ("measurements", "active_power_kw"),
    "power_factor": ("measurements", "power_factor"),
    "frequency": ("measurements", "frequency_hz"),
    "energy": ("measurements", "total_energy_kwh"),
    "status_code": ("status", "code"),
}

METRICS = MESSAGE["measurements"].dataType.names

# Value of a history column that a file does not have at all.
HISTORY_DEFAULTS = {
    "location_city": "Unknown",
    "location_district": "Unknown",
    "location_gps": "0.0,0.0",
    **{f"measurements_{metric}": 0.0 for metric in METRICS},
    "status_code": 0,
    "status_message": "OK",
    "status_battery_level": 100,
}

FEATURES = ["voltage", "current", "power_factor", "frequency"]
LABEL = "power"
