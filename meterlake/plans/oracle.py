"""DuckDB SQL for the queries of the catalog, over the same tables."""

from __future__ import annotations

# Readings (mr) and cleaned readings (cl); pu is power in units of 0.0001 kW.
BASE = """
WITH mr0 AS (
  SELECT event_id,
    'LCL-' || lpad(CAST(user_id AS VARCHAR), 4, '0') AS meter_id,
    ts AS event_time, CAST(ts AS DATE) AS date,
    (['Camden','Westminster','Greenwich','Hackney','Islington','Chelsea','Kensington',
      'Hammersmith','Fulham','Brixton'])[CAST(user_id % 10 AS INT) + 1] AS district,
    CASE WHEN event_type = 'signup' THEN NULL WHEN event_id % 97 = 0 THEN 0.0::DOUBLE
         ELSE 200.0::DOUBLE + CAST(json_extract_string(props, '$.k') AS INT) * 0.5::DOUBLE
    END AS voltage,
    value AS current,
    CASE WHEN event_id % 89 = 0 THEN -10000::BIGINT
         ELSE (209 * CAST(round(value * 100) AS BIGINT) * (95 + event_id % 11)) // 1000 END AS pu,
    0.95::DOUBLE AS power_factor,
    CAST(4998 + event_id % 5 AS DOUBLE) / 100.0::DOUBLE AS frequency,
    CAST(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS INTEGER) AS status_code
  FROM events),
mr AS (
  SELECT *, CAST(pu AS DOUBLE) / 10000.0::DOUBLE AS power,
    1000.0::DOUBLE + CAST(sum(greatest(pu, 0)) OVER (PARTITION BY meter_id
      ORDER BY event_time, event_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) / 20000.0::DOUBLE AS energy
  FROM mr0),
cl AS (
  SELECT * FROM mr WHERE meter_id IS NOT NULL AND event_time IS NOT NULL
    AND coalesce(voltage, 1.0::DOUBLE) > 0 AND coalesce(power, 0.0::DOUBLE) >= 0)
"""

# Least squares of power on voltage, current and frequency (power factor is constant), by
# the normal equations around the means.
GUESS = "round(b0 + bv*voltage + bi*current + bf*frequency, 3)"
FIT = f""",
tr AS (SELECT voltage AS v, current AS i, frequency AS f, power AS p FROM cl
       WHERE voltage IS NOT NULL AND current IS NOT NULL),
mu AS (SELECT avg(v) AS mv, avg(i) AS mi, avg(f) AS mf, avg(p) AS mp FROM tr),
s AS (SELECT sum((v-mv)*(v-mv)) AS vv, sum((v-mv)*(i-mi)) AS vi, sum((v-mv)*(f-mf)) AS vf,
             sum((i-mi)*(i-mi)) AS ii, sum((i-mi)*(f-mf)) AS fi, sum((f-mf)*(f-mf)) AS ff,
             sum((v-mv)*(p-mp)) AS vp, sum((i-mi)*(p-mp)) AS ip, sum((f-mf)*(p-mp)) AS fp
      FROM tr, mu),
d AS (SELECT *, vv*(ii*ff-fi*fi) - vi*(vi*ff-fi*vf) + vf*(vi*fi-ii*vf) AS det FROM s),
w AS (SELECT
        (vp*(ii*ff-fi*fi) - vi*(ip*ff-fi*fp) + vf*(ip*fi-ii*fp)) / det AS bv,
        (vv*(ip*ff-fi*fp) - vp*(vi*ff-fi*vf) + vf*(vi*fp-ip*vf)) / det AS bi,
        (vv*(ii*fp-ip*fi) - vi*(vi*fp-ip*vf) + vp*(vi*fi-ii*vf)) / det AS bf FROM d),
b AS (SELECT bv, bi, bf, mp - bv*mv - bi*mi - bf*mf AS b0 FROM w, mu),
pr AS (SELECT meter_id, event_time, power AS actual_power,
         {GUESS} AS predicted_power
       FROM cl, b WHERE voltage IS NOT NULL AND current IS NOT NULL)
"""

READING = (
    "meter_id, event_time, date, district, voltage, current, power, power_factor, "
    "frequency, energy, status_code"
)
UNCOUNTED = READING.replace("energy, ", "")
MILLIS = "date_trunc('millisecond', event_time) AS event_time"
ISO = "strftime(event_time, '%Y-%m-%dT%H:%M:%S.%g') || 'Z'"
STREAMED = (
    f"meter_id, {MILLIS}, date, district, voltage, current, power, power_factor, frequency, "
    "energy, status_code"
)
METRICS = (
    "voltage AS voltage_v, current AS current_a, power AS active_power_kw, power_factor, "
    "frequency AS frequency_hz"
)
ENERGY = "CAST(sum(pu) AS DOUBLE) / 20000.0::DOUBLE"
OVER_240 = (
    "meter_id, {time}, 'OverVoltage' AS rule, 'CRITICAL' AS type, "
    "format('Over-voltage detected: {{:.2f}}V', voltage) AS message, "
    "'Cut-off triggered' AS action"
)
POINTS = """,
r AS (SELECT * FROM cl ORDER BY event_time DESC, event_id DESC LIMIT 100),
v AS (SELECT event_time, meter_id, arg_min(voltage, event_id) AS voltage
      FROM r WHERE voltage IS NOT NULL GROUP BY ALL)
"""

SQL = {
    "lake_scan": f"SELECT {READING} FROM cl",
    "lake_count": "SELECT count(*) AS record_count FROM cl",
    "latest_partition": f"SELECT {READING} FROM cl WHERE date = (SELECT max(date) FROM cl)",
    "compacted_partition": f"SELECT {READING} FROM cl WHERE date = (SELECT max(date) FROM cl)",
    "compacted_lake": f"SELECT {READING} FROM cl",
    "published_messages": """
SELECT meter_id, strftime(TIMESTAMP '2024-02-01 00:00:00' + to_seconds(2 * (row_number() OVER (
    PARTITION BY meter_id ORDER BY event_time) - 1)), '%Y-%m-%dT%H:%M:%S.%g') || 'Z' AS timestamp,
  current AS current_a
FROM mr""",
    "predictions_scan": FIT
    + "SELECT * REPLACE (date_trunc('millisecond', event_time) AS event_time) FROM pr",
    "csv_roundtrip": """
SELECT meter_id, date_trunc('second', event_time) AS timestamp,
  'Unknown' AS location_city, district AS location_district, '0.0,0.0' AS location_gps,
  voltage AS measurements_voltage_v, current AS measurements_current_a,
  power AS measurements_active_power_kw, power_factor AS measurements_power_factor,
  frequency AS measurements_frequency_hz, energy AS measurements_total_energy_kwh,
  status_code, 'OK' AS status_message, 100 AS status_battery_level
FROM mr""",
    "json_encode": f"""
SELECT '{{"meter_id":"' || meter_id || '","timestamp":"' || {ISO}
  || '","location":{{"city":"Unknown","district":"' || district || '","gps":"0.0,0.0"}}'
  || ',"measurements":{{' || coalesce('"voltage_v":' || to_json(voltage) || ',', '')
  || '"current_a":' || to_json(current) || ',"active_power_kw":' || to_json(power)
  || ',"power_factor":' || to_json(power_factor) || ',"frequency_hz":' || to_json(frequency)
  || ',"total_energy_kwh":' || to_json(energy) || '}},"status":{{"code":' || status_code
  || ',"message":"OK","battery_level":100}}}}' AS value
FROM cl""",
    "json_decode": f"""
SELECT meter_id, {ISO} AS timestamp, 'Unknown' AS city, district, '0.0,0.0' AS gps, {METRICS},
  energy AS total_energy_kwh, status_code AS code, 'OK' AS message, 100 AS battery_level
FROM mr""",
    "json_decode_narrow": f"SELECT meter_id, {ISO} AS timestamp, {METRICS} FROM mr",
    "flatten_readings": f"SELECT {STREAMED} FROM mr",
    "metric_mask": f"""
SELECT meter_id, {ISO} AS timestamp, voltage AS voltage_v, NULL::DOUBLE AS current_a,
  power AS active_power_kw, NULL::DOUBLE AS power_factor, NULL::DOUBLE AS frequency_hz,
  NULL::DOUBLE AS total_energy_kwh
FROM mr""",
    "schema_align": """
SELECT meter_id, event_time AS timestamp, 'Unknown' AS location_city,
  'Unknown' AS location_district, '0.0,0.0' AS location_gps,
  voltage AS measurements_voltage_v, current AS measurements_current_a,
  power AS measurements_active_power_kw, power_factor AS measurements_power_factor,
  frequency AS measurements_frequency_hz, 0.0::DOUBLE AS measurements_total_energy_kwh,
  status_code, 'OK' AS status_message, CAST(70 + status_code AS INTEGER) AS status_battery_level
FROM mr""",
    "union_parts": f"""
SELECT {UNCOUNTED} FROM cl WHERE status_code = 0 UNION ALL
SELECT {UNCOUNTED.replace("district", "NULL::VARCHAR AS district")}
FROM cl WHERE status_code <> 0""",
    "clean_readings": f"SELECT {UNCOUNTED} FROM cl",
    "scoring_features": f"""
SELECT meter_id, {MILLIS}, voltage, current, power_factor, frequency, power AS actual_power
FROM mr WHERE voltage IS NOT NULL AND current IS NOT NULL""",
    "training_set": """
SELECT voltage, current, power_factor, frequency, power FROM cl
WHERE voltage IS NOT NULL AND current IS NOT NULL""",
    "meter_subset": f"""
SELECT {UNCOUNTED} FROM cl
WHERE meter_id IN (SELECT DISTINCT meter_id FROM cl ORDER BY meter_id LIMIT 5)""",
    "distinct_meters": "SELECT DISTINCT meter_id FROM cl",
    "meter_shards": """
SELECT meter_id, (dense_rank() OVER (ORDER BY meter_id) - 1) % 5 AS shard
FROM (SELECT DISTINCT meter_id FROM cl)""",
    "sample_readings": f"""
SELECT {UNCOUNTED} FROM cl
WHERE CAST('0x' || substr(md5(meter_id || '@' || epoch_us(event_time)), 1, 8) AS BIGINT) % 100
  < 10""",
    "sample_per_meter": f"""
SELECT {UNCOUNTED} FROM cl
QUALIFY row_number() OVER (PARTITION BY meter_id
  ORDER BY md5(meter_id || '@' || epoch_us(event_time)), event_time, event_id) <= 50""",
    "latest_per_meter": f"""
SELECT event_id, {UNCOUNTED} FROM cl
QUALIFY row_number() OVER (PARTITION BY meter_id ORDER BY event_time DESC, event_id DESC) = 1""",
    "grid_overview": """
SELECT count(*) AS active_nodes, CASE WHEN count(*) = 0 THEN 0.0 ELSE avg(voltage) END
    AS avg_voltage,
  CAST(coalesce(sum(pu), 0) AS DOUBLE) / 10000.0::DOUBLE AS total_load_kw,
  CASE WHEN count(*) = 0 THEN 'OFFLINE' WHEN avg(voltage) BETWEEN 200 AND 240 THEN 'NOMINAL'
       ELSE 'UNSTABLE' END AS grid_status
FROM (FROM cl QUALIFY row_number() OVER (PARTITION BY meter_id
        ORDER BY event_time DESC, event_id DESC) = 1)""",
    "energy_by_meter": "SELECT meter_id, max(energy) AS energy_kwh FROM cl GROUP BY meter_id",
    "lake_summary": """
SELECT count(*) AS record_count,
  CAST(sum(pu) AS DOUBLE) / 10000.0::DOUBLE / count(pu) AS avg_power_kw,
  max(event_time) AS newest_event_time FROM cl""",
    "lake_top500": f"SELECT {READING} FROM cl ORDER BY event_time DESC, meter_id DESC LIMIT 500",
    "recent_log": """
SELECT event_time, meter_id, voltage, power FROM cl
ORDER BY event_time DESC, meter_id DESC LIMIT 10""",
    "voltage_pivot": POINTS
    + """
SELECT event_time, '{' || string_agg('"' || meter_id || '":' || to_json(voltage), ','
  ORDER BY meter_id) || '}' AS voltages
FROM v GROUP BY event_time""",
    "voltage_filled": POINTS
    + """,
g AS (SELECT t.event_time, m.meter_id FROM (SELECT DISTINCT event_time FROM v) t
      CROSS JOIN (SELECT DISTINCT meter_id FROM v) m),
j AS (SELECT g.event_time, g.meter_id, v.voltage FROM g LEFT JOIN v
      ON g.event_time = v.event_time AND g.meter_id = v.meter_id)
SELECT event_time, meter_id, coalesce(
  last_value(voltage IGNORE NULLS) OVER (PARTITION BY meter_id ORDER BY event_time
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
  first_value(voltage IGNORE NULLS) OVER (PARTITION BY meter_id ORDER BY event_time
    ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS voltage FROM j""",
    "voltage_filled_all": """,
p AS (SELECT meter_id, date_trunc('hour', event_time) AS step, arg_min(voltage, event_time) AS voltage
      FROM cl WHERE voltage IS NOT NULL GROUP BY ALL),
g AS (SELECT t.step, m.meter_id
      FROM (SELECT unnest(generate_series(min(step), max(step), INTERVAL 1 HOUR)) AS step FROM p) t
      CROSS JOIN (SELECT DISTINCT meter_id FROM p) m),
j AS (SELECT g.step, g.meter_id, p.voltage FROM g LEFT JOIN p USING (step, meter_id))
SELECT step AS event_time, meter_id, coalesce(
  last_value(voltage IGNORE NULLS) OVER (PARTITION BY meter_id ORDER BY step
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
  first_value(voltage IGNORE NULLS) OVER (PARTITION BY meter_id ORDER BY step
    ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS voltage FROM j""",
    "load_bands": """
SELECT CASE WHEN hour(event_time) <= 5 THEN 'night' WHEN hour(event_time) BETWEEN 6 AND 9
    THEN 'morning' WHEN hour(event_time) BETWEEN 17 AND 22 THEN 'peak' ELSE 'day' END AS band,
  count(*) AS readings,
  CAST(sum(pu) AS DOUBLE) / 10000.0::DOUBLE / count(pu) AS avg_power_kw,
  max(power) AS max_power_kw
FROM cl GROUP BY band""",
    "power_residual": """
SELECT meter_id, event_time, power, ideal_power, abs(power - ideal_power) AS gap_kw,
  abs(power - ideal_power) > 0.05::DOUBLE * ideal_power AS out_of_tolerance
FROM (SELECT *, voltage * current * power_factor / 1000.0::DOUBLE AS ideal_power FROM cl)""",
    "consumption_rollup": f"""
SELECT meter_id, grain, CAST(date_trunc(grain, date) AS DATE) AS period_start,
  {ENERGY} AS energy_kwh
FROM cl, (VALUES ('day'), ('month'), ('year')) AS g(grain) GROUP BY ALL""",
    "counter_rollup": """,
c AS (SELECT meter_id, event_time, event_id, date,
        CAST(round(energy * 100000) AS BIGINT) % 5000000 AS units
      FROM cl WHERE voltage IS NOT NULL),
d AS (SELECT *, lag(units) OVER (PARTITION BY meter_id ORDER BY event_time, event_id) AS before
      FROM c)
SELECT meter_id, grain, CAST(date_trunc(grain, date) AS DATE) AS period_start,
  CAST(sum(CASE WHEN before IS NULL THEN 0 WHEN units < before THEN units
    ELSE units - before END) AS DOUBLE) / 100000.0::DOUBLE AS energy_kwh,
  count(*) FILTER (units < before) AS resets
FROM d, (VALUES ('day'), ('month'), ('year')) AS g(grain) GROUP BY ALL""",
    "window_3d": f"""
SELECT meter_id, ws AS window_start, ws + INTERVAL 3 DAY AS window_end, count(*) AS readings,
  {ENERGY} AS energy_kwh
FROM (SELECT *, time_bucket(INTERVAL '3 days', event_time, TIMESTAMP '1970-01-01') AS ws FROM cl)
GROUP BY ALL""",
    "month_forecast": """
SELECT meter_id, date, CAST(mtd AS DOUBLE) / 20000.0::DOUBLE AS month_to_date_kwh,
  CAST(mtd AS DOUBLE) / 20000.0::DOUBLE * day(last_day(date)) / day(date) AS forecast_kwh
FROM (SELECT meter_id, date, sum(day_pu) OVER (PARTITION BY meter_id, date_trunc('month', date)
        ORDER BY date) AS mtd
      FROM (SELECT meter_id, date, sum(pu) AS day_pu FROM cl GROUP BY ALL))
WHERE day(date) >= 3""",
    "running_energy": """
SELECT meter_id, event_time, power, CAST(sum(pu) OVER (PARTITION BY meter_id
    ORDER BY event_time, event_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) / 20000.0::DOUBLE AS energy_kwh
FROM cl""",
    "replay_schedule": """,
n AS (SELECT *, row_number() OVER (PARTITION BY meter_id ORDER BY event_time, event_id) - 1
        AS position, count(*) OVER (PARTITION BY meter_id) AS length FROM cl),
l AS (SELECT DISTINCT meter_id, length FROM n)
SELECT l.meter_id, t.tick, n.position, n.event_time, n.voltage, n.power
FROM l CROSS JOIN (SELECT unnest(range(0, max(length))) AS tick FROM n) AS t
JOIN n ON n.meter_id = l.meter_id AND n.position = t.tick % l.length""",
    "overvoltage_alerts": f"""
SELECT {OVER_240.format(time="event_time")} FROM cl WHERE voltage > 240""",
    "alert_rules": f"""
SELECT {OVER_240.format(time="event_time")} FROM cl WHERE voltage > 240 UNION ALL
SELECT {OVER_240.format(time="event_time").replace("'OverVoltage'", "'HighOverVoltage'")}
FROM cl WHERE voltage > 245""",
    "alerts_beside_failures": f"""
SELECT {OVER_240.format(time="event_time")} FROM cl WHERE voltage > 240 UNION ALL
SELECT meter_id, event_time, 'PowerPerVolt', 'WARNING', 'Steep', 'Inspect'
FROM cl WHERE voltage <> 230 AND power / (voltage - 230) > 1""",
    "rule_failures": """
SELECT meter_id, event_time, 'PowerPerVolt' AS rule FROM cl WHERE voltage = 230""",
    "train_report": FIT
    + """,
q AS (SELECT count(*) AS n, avg((p-g)*(p-g)) AS mse, var_pop(p) AS spread
      FROM (SELECT p, b0 + bv*v + bi*i + bf*f AS g FROM tr, b))
SELECT 'voltage' AS term, round(bv, 4) AS value FROM b UNION ALL
SELECT 'current', round(bi, 4) FROM b UNION ALL
SELECT 'power_factor', NULL::DOUBLE UNION ALL
SELECT 'frequency', round(bf, 4) FROM b UNION ALL
SELECT 'level', round(b0, 4) FROM b UNION ALL
SELECT 'rmse', round(sqrt(mse), 4) FROM q UNION ALL
SELECT 'r2', round(1 - mse / spread, 4) FROM q UNION ALL
SELECT 'rows', n::DOUBLE FROM q""",
    "score_batch": FIT + "SELECT * FROM pr",
    "recent_predictions": FIT
    + """SELECT * FROM pr
WHERE event_time >= (SELECT max(event_time) FROM pr) - INTERVAL 1 HOUR
ORDER BY event_time DESC, meter_id DESC LIMIT 500""",
    "forecast_series": FIT
    + "SELECT * FROM pr ORDER BY event_time DESC, meter_id DESC LIMIT 60",
    "forecast_error": FIT
    + """SELECT *, abs(actual_power - predicted_power) AS error_kw,
  CASE WHEN actual_power > 0
       THEN abs(actual_power - predicted_power) / actual_power * 100.0::DOUBLE
       ELSE 0.0::DOUBLE END AS error_pct
FROM pr ORDER BY event_time DESC, meter_id DESC LIMIT 1""",
    "stream_ingest": f"SELECT {STREAMED} FROM cl",
    "stream_ingest_once": f"SELECT DISTINCT {STREAMED} FROM cl",
    "repeated_readings": f"""
SELECT meter_id, event_time, date, count(*) - 1 AS repeats
FROM (SELECT {READING} FROM cl UNION ALL SELECT {READING} FROM cl WHERE status_code = 1)
GROUP BY {READING} HAVING count(*) > 1""",
    "stream_predict": FIT
    + f"SELECT meter_id, {MILLIS}, power AS actual_power, {GUESS} AS predicted_power"
    + " FROM mr, b WHERE voltage IS NOT NULL AND current IS NOT NULL",
    "stream_alerts": f"SELECT {OVER_240.format(time=MILLIS)} FROM cl WHERE voltage > 240",
    "stream_window": f"""
SELECT meter_id, ws AS window_start, ws + INTERVAL 1 HOUR AS window_end, count(*) AS readings,
  {ENERGY} AS energy_kwh
FROM (SELECT *, time_bucket(INTERVAL '1 hour', event_time) AS ws FROM cl)
GROUP BY ALL""",
}

SQL["stream_forecast"] = SQL["month_forecast"]
SQL["train_incremental"] = SQL["train_report"]


def oracle_sql() -> dict[str, str]:
    return {name: BASE + body for name, body in SQL.items()}
