import datetime as dt

import pytest
from pyspark.sql import functions as F

from meterlake import schemas
from meterlake.operators import clean, sampling, shape

GOOD = (
    '{"meter_id":"m","timestamp":"2024-01-02T03:04:05.678Z","location":{"district":"Camden"},'
    '"measurements":{"voltage_v":230.0,"current_a":2.0,"active_power_kw":0.4,'
    '"power_factor":0.95,"frequency_hz":50.0,"total_energy_kwh":7.5},"status":{"code":0}}'
)


def message(measurements, time="2024-01-02T03:04:05.678Z"):
    return f'{{"meter_id":"m","timestamp":"{time}","measurements":{measurements}}}'


EDGES = {
    GOOD: True,
    message('{"voltage_v": NaN, "active_power_kw": NaN}'): True,
    message("{}"): True,
    "not json": False,
    message('{"voltage_v":"abc","current_a":2}'): True,
    message('{"voltage_v":0.0}'): False,
    message('{"active_power_kw":-0.1}'): False,
    message("{}", time="garbage"): False,
}


def decoded(spark, texts):
    return shape.decode_messages(
        spark.createDataFrame([(bytearray(t, "utf-8"),) for t in texts], "value binary")
    )


@pytest.mark.parametrize("text,kept", EDGES.items())
def test_cleaning_of_edge_messages(spark, text, kept):
    assert clean.clean_readings(shape.flatten(decoded(spark, [text]))).count() == int(kept)


def test_only_complete_messages_are_scored(spark):
    features = shape.scoring_projection(decoded(spark, list(EDGES)))
    assert clean.scoring_rows(features).count() == 1


def test_flatten_types_and_values(spark):
    flat = shape.flatten(decoded(spark, [GOOD]))
    assert [(f.name, f.dataType) for f in flat.schema] == [
        (f.name, f.dataType) for f in schemas.READING
    ]
    assert flat.first().asDict() == {
        "meter_id": "m",
        "event_time": dt.datetime(2024, 1, 2, 3, 4, 5, 678000),
        "date": dt.date(2024, 1, 2),
        "district": "Camden",
        "voltage": 230.0,
        "current": 2.0,
        "power": 0.4,
        "power_factor": 0.95,
        "frequency": 50.0,
        "energy": 7.5,
        "status_code": 0,
    }


def test_narrow_schema_reads_the_same_features(spark):
    texts = spark.createDataFrame([(t,) for t in EDGES], "value string")
    wide = shape.scoring_projection(shape.decode_messages(texts))
    narrow = shape.scoring_projection(shape.decode_messages(texts, schemas.SCORING_MESSAGE))
    assert sorted(map(repr, wide.collect())) == sorted(map(repr, narrow.collect()))


def test_align_fills_absent_columns_only(spark):
    row = spark.sql(
        "SELECT 'm' AS meter_id, TIMESTAMP'2024-01-01' AS timestamp, "
        "CAST(NULL AS DOUBLE) AS measurements_voltage_v, '3.5' AS measurements_current_a, "
        "'x' AS status_code"
    )
    aligned = shape.align_history(row)
    assert [(f.name, f.dataType) for f in aligned.schema] == [
        (f.name, f.dataType) for f in schemas.HISTORY
    ]
    got = aligned.first()
    assert got.measurements_voltage_v is None and got.status_code is None
    assert got.measurements_current_a == 3.5
    assert got.measurements_total_energy_kwh == 0.0
    assert (got.location_city, got.location_gps) == ("Unknown", "0.0,0.0")
    assert (got.status_message, got.status_battery_level) == ("OK", 100)


def test_align_needs_meter_and_time(spark):
    with pytest.raises(KeyError):
        shape.align_history(spark.sql("SELECT 'm' AS meter_id"))


def test_disabled_metrics_are_absent_keys(spark):
    history = shape.readings_to_history(shape.flatten(decoded(spark, [GOOD])))
    sent_at = F.lit("2030-01-01").cast("timestamp")
    records = shape.nest_history(history, ["voltage_v"], sent_at)
    (row,) = shape.to_messages(records).collect()
    assert '"measurements":{"voltage_v":230.0}' in row.value
    assert '"timestamp":"2030-01-01T00:00:00.000Z"' in row.value


def test_union_keeps_all_rows(spark):
    a, b = spark.sql("SELECT 1 AS x, 2 AS y"), spark.sql("SELECT 3 AS x")
    assert sorted(tuple(r) for r in shape.union_parts(a, b, a).fillna(0).collect()) == [
        (1, 2), (1, 2), (3, 0)
    ]


def test_log_view_takes_what_is_there(spark):
    assert shape.log_view(spark.sql("SELECT 1 AS power, 2 AS x")).columns == ["power"]


def test_since_and_only_meters(spark):
    rows = spark.sql(
        "SELECT * FROM VALUES ('a', TIMESTAMP'2024-01-01 10:00:00'), "
        "('b', TIMESTAMP'2024-01-01 11:00:00'), ('c', NULL) AS t(meter_id, event_time)"
    )
    as_of = F.lit("2024-01-01 11:30:00").cast("timestamp")
    assert [r.meter_id for r in clean.since(rows, as_of).collect()] == ["b"]
    assert clean.since(rows, as_of, hours=2).count() == 2
    assert clean.only_meters(rows, ["a", "c"]).count() == 2
    assert clean.only_meters(rows, rows.where("meter_id = 'b'").select("meter_id")).count() == 1


def test_sample_is_repeatable_and_near_the_share(spark):
    rows = spark.range(20_000).selectExpr(
        "concat('m', id % 7) AS meter_id", "timestamp_seconds(id) AS event_time"
    )
    first = {tuple(r) for r in sampling.sample_readings(rows, 10).collect()}
    again = {tuple(r) for r in sampling.sample_readings(rows.repartition(5), 10).collect()}
    assert first == again
    assert 1800 < len(first) < 2200
    assert first < {tuple(r) for r in sampling.sample_readings(rows, 20).collect()}


def test_empty_messages_give_a_row_of_nulls(spark):
    texts = spark.createDataFrame([(None,), ("",), ("[]",), ("null",)], "value string")
    rows = shape.decode_messages(texts).collect()
    assert [set(row) for row in rows] == [{None}] * 4
    assert clean.clean_readings(shape.flatten(shape.decode_messages(texts))).count() == 0
