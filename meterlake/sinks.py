"""Writing lake, prediction and history tables in batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from meterlake import schemas
from meterlake.sources import files, runs


def write_lake(readings: DataFrame, path: str, mode: str = "append") -> None:
    """Readings as Parquet by date.

    Rebalancing gathers a date's rows before the write, so that not every task adds a small
    file to every date, and splits dates that are too large for one task. With mode
    "overwrite" only the dates that the readings have are replaced.
    """
    writer = readings.hint("rebalance", "date").write.mode(mode)
    writer.option("partitionOverwriteMode", "dynamic").partitionBy("date").parquet(path)


def compact_lake(
    spark: SparkSession, source: str, target: str, date: str | None = None
) -> dict[str, int]:
    """Take the files that a lake has got since the last time into full-size ones.

    `target` is another path, a table of runs with a part for each date: rows and the names of
    the files they came from appear there together, so that `files.read_compacted_lake` counts
    every row once, whatever comes to a date later. The new run takes in earlier ones of a date
    that are not much larger. The lake itself is left as it is; a folder written by a stream
    lists its files in a log, and readers would not see others. One compaction of a lake runs at
    a time. Files without a date folder stay in the lake. Returns the dates, all or the given
    one, with the number of rows that were not compacted before.
    """
    if source.rstrip("/") == target.rstrip("/"):
        raise ValueError("compact into another path than the lake's own")
    table, name = runs.RunTable(spark, target), runs.new_name()
    live = table.live()
    names, pinned = files.pin_new_files(spark, source, table, live, name, date)
    dates = [row.date for row in names.select("date").distinct().collect()]
    rows = files.rows_of_files(spark, source, names)
    new = {str(row.date): row["count"] for row in rows.groupBy("date").count().collect()}
    new = {one: new.get(one, 0) for one in dates}
    if dates:
        own = {one: [run for run in live if run.part == one] for one in dates}
        merged = {one: runs.to_merge(own[one], new[one]) for one in dates}
        old = [run for some in merged.values() for run in some]
        everything = rows.unionByName(table.read(old, schemas.READING))
        write_lake(everything, table.folder(name))
        earlier = files.taken_files(table, old).withColumn("name", F.lit(name))
        names.unionByName(earlier).coalesce(1).write.parquet(table.folder(name, runs.BESIDE))
        added = [
            runs.Run(
                name, one, new[one] + sum(run.rows for run in merged[one]),
                1 + max((run.last for run in own[one]), default=0),
            )
            for one in dates
        ]
        table.commit("lake", [run for run in added if run.rows], old)
    table.discard(pinned)
    return new


def write_predictions(predictions: DataFrame, path: str, mode: str = "append") -> None:
    """Predictions as JSON by date."""
    dated = predictions.withColumn("date", F.to_date("event_time"))
    dated.write.mode(mode).partitionBy("date").json(path)


def write_history(history: DataFrame, path: str, mode: str = "append") -> None:
    history.write.mode(mode).csv(path, header=True, timestampFormat=files.HISTORY_TIME)
