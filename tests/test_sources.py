import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from meterlake import schemas, sinks
from meterlake.jobs import parser
from meterlake.session import scratch_path
from meterlake.sources import files, kafka, runs

DAYS = [dt.date(2024, 1, d) for d in (1, 2, 3)]


def lake_rows(spark, days=DAYS, meters=4):
    return spark.createDataFrame(
        [
            (f"m{m}", dt.datetime.combine(day, dt.time(m)), day, "Camden", 230.0, 1.0, 0.2, 0.9,
             50.0, 1.0, 0)
            for day in days
            for m in range(meters)
        ],
        schemas.READING,
    )


def test_missing_paths_have_no_rows(spark, tmp_path):
    for read in (files.read_lake, files.read_latest_partition, files.read_predictions):
        found = read(spark, str(tmp_path / "nothing"))
        assert found.count() == 0
    assert files.read_lake(spark, str(tmp_path / "nothing")).schema == schemas.READING


def test_other_errors_propagate(spark):
    with pytest.raises(Exception, match="nosuchscheme"):
        files.read_lake(spark, "nosuchscheme://host/path")


def test_lake_roundtrip_and_newest_date(spark, tmp_path):
    path = str(tmp_path / "lake")
    rows = lake_rows(spark)
    sinks.write_lake(rows, path)
    assert sorted(files.read_lake(spark, path).collect()) == sorted(rows.collect())
    newest = files.read_latest_partition(spark, path).collect()
    assert {r.date for r in newest} == {DAYS[-1]} and len(newest) == 4


def test_one_file_per_small_date(spark, tmp_path):
    path = tmp_path / "lake"
    sinks.write_lake(lake_rows(spark).repartition(8), str(path))
    assert all(len(list(d.glob("*.parquet"))) == 1 for d in path.glob("date=*"))


def test_newest_date_of_a_lake_without_partitions(spark, tmp_path):
    lake_rows(spark).write.parquet(str(tmp_path / "flat"))
    assert files.read_latest_partition(spark, str(tmp_path / "flat")).count() == 4
    lake_rows(spark).drop("date").write.parquet(str(tmp_path / "dateless"))
    assert files.read_latest_partition(spark, str(tmp_path / "dateless")).count() == 12


def test_rows_and_files_without_time_are_left_out(spark, tmp_path):
    path = str(tmp_path / "lake")
    lake_rows(spark).write.parquet(path)
    lake_rows(spark).drop("event_time").write.mode("append").parquet(path)
    assert files.read_lake(spark, path).count() == 12


def test_corrupt_files_are_skipped_on_request(spark, tmp_path):
    path = tmp_path / "lake"
    lake_rows(spark).write.parquet(str(path))
    (path / "part-bad.snappy.parquet").write_bytes(b"PAR1 not a table PAR1")
    with pytest.raises(Exception):
        files.read_lake(spark, str(path)).collect()
    assert files.read_lake(spark, str(path), skip_corrupt=True).count() == 12


def test_compaction(spark, tmp_path):
    source, target = str(tmp_path / "lake"), str(tmp_path / "compact")
    for _ in range(3):
        lake_rows(spark).repartition(4).write.mode("append").partitionBy("date").parquet(source)
    counts = [sinks.compact_lake(spark, source, target, "2024-01-02") for _ in range(2)]
    assert counts == [{"2024-01-02": 12}, {}]  # a job that runs again repeats no row
    with pytest.raises(ValueError, match="another path"):
        sinks.compact_lake(spark, source, source + "/", "2024-01-02")
    table = runs.RunTable(spark, target)
    (run,) = table.live()
    rows = table.read([run], schemas.READING).collect()
    assert {r.date for r in rows} == {DAYS[1]} and len(rows) == run.rows == 12
    assert len(list(Path(table.rows_folder(run)).glob("*.parquet"))) == 1


def test_late_readings_of_compacted_dates(spark, tmp_path):
    """Every reading counts once: compacted, late, late and compacted again."""
    source, target = str(tmp_path / "lake"), str(tmp_path / "compact")
    sinks.write_lake(lake_rows(spark), source)
    both = lambda: files.read_compacted_lake(spark, source, target)
    whole = lambda: files.read_lake(spark, source)
    assert both().count() == 12
    for date in ("2024-01-01", "2024-01-03", "2024-07-07"):
        sinks.compact_lake(spark, source, target, date)
    assert sorted(both().collect()) == sorted(lake_rows(spark).collect())
    for turn in range(6):
        late = lake_rows(spark).where(F.col("date") == F.lit(DAYS[turn % 3]))
        sinks.write_lake(late.withColumn("energy", F.lit(100.0 + turn)), source)
        assert sorted(both().collect()) == sorted(whole().collect())
        if turn % 2:
            assert sinks.compact_lake(spark, source, target)
            assert sorted(both().collect()) == sorted(whole().collect())
    assert sinks.compact_lake(spark, source, target) == {}
    live = runs.RunTable(spark, target).live()
    assert sum(run.rows for run in live) == whole().count() == 36
    assert len(live) <= 6
    latest = files.read_latest_partition(spark, source, compacted=target)
    assert sorted(latest.collect()) == sorted(files.read_latest_partition(spark, source).collect())


def test_compacted_dates_are_not_opened_in_the_lake(spark, tmp_path):
    source, target = tmp_path / "lake", str(tmp_path / "compact")
    sinks.write_lake(lake_rows(spark), str(source))
    sinks.compact_lake(spark, str(source), target)
    for file in source.glob("date=*/*.parquet"):
        file.write_bytes(b"not a table")
    assert files.read_compacted_lake(spark, str(source), target).count() == 12
    # Nor are older files of a date that has a late one.
    sinks.write_lake(lake_rows(spark, DAYS[:1], 1), str(source))
    assert files.read_compacted_lake(spark, str(source), target).count() == 13
    assert sinks.compact_lake(spark, str(source), target) == {"2024-01-01": 1}


def test_failed_compaction_counts_nothing(spark, tmp_path, monkeypatch):
    source, target = str(tmp_path / "lake"), str(tmp_path / "compact")
    sinks.write_lake(lake_rows(spark), source)

    def fail(*_):
        raise RuntimeError("lost before the commit")

    with monkeypatch.context() as broken:
        broken.setattr(runs.RunTable, "commit", fail)
        with pytest.raises(RuntimeError):
            sinks.compact_lake(spark, source, target, "2024-01-01")
    assert files.read_compacted_lake(spark, source, target).count() == 12
    sinks.compact_lake(spark, source, target)
    assert files.read_compacted_lake(spark, source, target).count() == 12


def test_files_without_rows_are_named(spark, tmp_path):
    path = tmp_path / "lake"
    sinks.write_lake(lake_rows(spark), str(path))
    assert files.files_without_rows(spark, str(path)).collect() == []
    broken = path / "date=2024-01-02" / "part-9.parquet"
    broken.write_bytes(b"not a table")
    found = files.files_without_rows(spark, str(path)).collect()
    assert [tuple(row) for row in found] == [("date=2024-01-02/part-9.parquet", "2024-01-02")]
    assert files.files_without_rows(spark, str(path), "2024-01-01").collect() == []
    assert files.files_without_rows(spark, str(tmp_path / "none")).collect() == []


def test_runs_are_merged_to_few(spark, tmp_path):
    """Sizes of the runs grow by a factor, whatever the batches bring; folders stay few."""
    table, total = runs.RunTable(spark, str(tmp_path)), 0
    for number in range(12):
        rows = spark.range(total, total + 1 + number % 3)
        total += 1 + number % 3
        live = table.live("q")
        merged = runs.to_merge(live, 1 + number % 3)
        both = rows.unionByName(table.read(merged, rows.schema))
        table.commit("q", [table.write(both, number)], merged)
        table.commit("other", [])
    live = table.live()
    assert sorted(r.id for r in table.read(live, rows.schema).collect()) == list(range(total))
    sizes = [run.rows for run in live]
    assert all(a >= 2 * b for a, b in zip(sizes, sizes[1:])) and len(sizes) <= 5
    assert len(list((tmp_path / "rows").iterdir())) <= 2 * len(sizes) + 2
    assert len(list((tmp_path / "log" / "q").iterdir())) <= runs.KEPT_VERSIONS


def test_newest_date_opens_no_file(spark, tmp_path):
    path = tmp_path / "lake"
    sinks.write_lake(lake_rows(spark), str(path))
    (path / "date=2024-02-01").mkdir()
    for file in path.glob("date=2024-01-0[12]/*.parquet"):
        file.write_bytes(b"not a table")
    assert files.read_latest_partition(spark, str(path)).count() == 4


def test_recent_predictions_read_recent_folders(spark, tmp_path):
    times = [dt.datetime(2024, 1, d, h) for d, h in ((1, 1), (2, 23), (3, 0))]
    rows = spark.createDataFrame([("m", t, 1.0, 1.0) for t in times], schemas.PREDICTION)
    sinks.write_predictions(rows, str(tmp_path))
    since = F.lit("2024-01-02 23:30:00").cast("timestamp")
    found = files.read_predictions(spark, str(tmp_path), since)
    assert {r.event_time.day for r in found.collect()} == {2, 3}
    assert len(found.inputFiles()) == 3
    plan = found._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters:")[1].split("PushedFilters")[0]
    assert "date" in filters
    assert files.read_predictions(spark, str(tmp_path)).count() == 3


def test_stream_reads_its_own_folder_only(spark, tmp_path):
    for name, n in (("ev", 3), ("ev_old", 5)):
        spark.range(n).write.parquet(str(tmp_path / name))
    stream = files.read_stream_of(spark, str(tmp_path / "ev"), spark.range(1).schema)
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    query = stream.writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint)
    query.start(out).awaitTermination()
    assert spark.read.parquet(out).count() == 3


def test_no_history(spark, tmp_path):
    rows = files.read_history(spark, str(tmp_path / "nothing"))
    assert rows.count() == 0 and rows.columns == schemas.HISTORY.names


def test_prediction_lines(spark, tmp_path):
    good = '{"meter_id":"m","event_time":"2024-01-01T00:00:00.000Z","actual_power":1.0}'
    lines = [good, "{broken", good.replace("2024-01-01T00:00:00.000Z", "never"), "{}", ""]
    (tmp_path / "part-0.json").write_text("\n".join(lines))
    (tmp_path / "other.json").write_text(good)
    (row,) = files.read_predictions(spark, str(tmp_path)).collect()
    assert row.event_time == dt.datetime(2024, 1, 1) and row.predicted_power is None


def test_history_csv(spark, tmp_path):
    (tmp_path / "h.csv").write_text(
        ",".join(schemas.HISTORY.names) + "\n"
        'LCL-001,2012-01-01 00:30:00,London,Camden,"51.536,-0.142",230.0,1.5,0.3278,0.95,'
        "49.99,1234.5,0,OK,100\n"
        "LCL-001,2012-01-01 01:00:00,London,Camden,,,,,,,,,,\n"
    )
    full, blank = files.read_history(spark, str(tmp_path)).orderBy("timestamp").collect()
    assert full.location_gps == "51.536,-0.142"
    assert full.timestamp == dt.datetime(2012, 1, 1, 0, 30)
    assert blank.measurements_voltage_v is None and blank.status_code is None


def test_history_csv_with_fewer_columns(spark, tmp_path):
    (tmp_path / "h.csv").write_text(
        "timestamp,extra,meter_id,measurements_current_a,status_code\n"
        "2012-01-01 00:30:00,x,LCL-001,1.5,\n"
        "soon,x,LCL-002,many,3\n"
    )
    first, second = files.read_history(spark, str(tmp_path)).orderBy("meter_id").collect()
    assert list(first.asDict()) == schemas.HISTORY.names
    assert first.timestamp == dt.datetime(2012, 1, 1, 0, 30)
    assert (first.measurements_current_a, first.measurements_voltage_v) == (1.5, 0.0)
    assert (first.status_code, first.status_message) == (None, "OK")
    assert (second.timestamp, second.measurements_current_a, second.status_code) == (None, None, 3)


def test_topic_options():
    ingest = kafka.source_options("k:9092", starting_offsets="earliest")
    assert ingest == {
        "kafka.bootstrap.servers": "k:9092",
        "subscribe": "smart-meter-data",
        "failOnDataLoss": "false",
        "startingOffsets": "earliest",
    }
    assert "startingOffsets" not in kafka.source_options("k:9092")
    limited = kafka.source_options("k:9092", max_offsets=10, max_records_per_task=5)
    assert limited["maxOffsetsPerTrigger"] == "10"
    assert limited["maxRecordsPerPartition"] == "5"
    sink = kafka.sink_options("k:9092", kafka.ALERTS_TOPIC)
    assert sink["topic"] == "plugins-data"
    assert (sink["kafka.acks"], sink["kafka.retries"]) == ("all", "3")


def test_scratch_is_under_the_shared_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x").startswith(f"{base}/meterlake/x-")


def test_job_arguments():
    args = parser().parse_args("score --servers k --model m --predictions p --checkpoint c".split())
    assert (args.run.__name__, args.topic) == ("score", "smart-meter-data")
    args = parser().parse_args("publish --history h --servers k --metrics voltage_v".split())
    assert args.metrics == ["voltage_v"]


def test_a_large_date_is_written_by_several_tasks(spark, tmp_path):
    path = tmp_path / "lake"
    rows = spark.range(400_000, numPartitions=8).selectExpr(
        "cast(id as string) AS meter_id",
        "timestamp_seconds(1704067200 + (id % 3) * 30000) AS event_time",
        "rand(1) AS voltage",
        "to_date(timestamp_seconds(1704067200 + (id % 3) * 30000)) AS date",
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        sinks.write_lake(rows, str(path))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(list(path.glob("date=2024-01-01/*.parquet"))) > 2
    assert files.read_lake(spark, str(path)).count() == 400_000
