"""Lake, prediction and history files."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F
from pyspark.sql.types import StructType

from meterlake import schemas
from meterlake.operators import shape
from meterlake.sources.runs import BESIDE, Run, RunTable, new_name, or_empty

# Fixed value: time format of history files.
HISTORY_TIME = "yyyy-MM-dd HH:mm:ss"

TAKEN = schemas.record(
    name=schemas.STRING, date=schemas.STRING, file=schemas.STRING, modified=schemas.TIMESTAMP
)

DATE_FOLDER = re.compile(r"/date=(\d{4}-\d{2}-\d{2})/")


def read_lake(spark: SparkSession, path: str, skip_corrupt: bool = False) -> DataFrame:
    """Readings under `path`, partitioned by date or not; no rows if it does not exist."""
    return _with_time(_scan_lake(spark, path, skip_corrupt))


def read_compacted_lake(
    spark: SparkSession, path: str, compacted: str | None, skip_corrupt: bool = False
) -> DataFrame:
    """The lake, with the files that a compaction has taken in read from `compacted`.

    Files that came later, to whatever date, are read from the lake. Dates without such files
    are not opened there at all.
    """
    if compacted is None:
        return read_lake(spark, path, skip_corrupt)
    table = RunTable(spark, compacted)
    live = table.live()
    taken = taken_files(table, live)
    # One row for each date with files that no compaction has taken in.
    fresh = not_taken(spark, path, taken).groupBy("date").agg(F.min("modified").alias("since"))
    found = fresh.collect()
    rows = table.read(live, schemas.READING)
    if found:
        late = _files_since(spark, path, found, skip_corrupt).join(taken, "file", "left_anti")
        rows = rows.unionByName(late.drop("file"))
    return _with_time(rows)


def _files_since(
    spark: SparkSession, path: str, dates: list[Row], skip_corrupt: bool
) -> DataFrame:
    """Readings, and their `file`, of some dates and of the time since their oldest new file.

    Spark leaves out other dates and older files when it lists them, without opening any.
    """
    named = [F.lit(row.date).cast("date") for row in dates if row.date]
    wanted = F.col("date").isin(named) if len(named) == len(dates) else F.lit(True)
    oldest = F.lit(min(row.since for row in dates))
    rows = _scan_lake(
        spark, path, skip_corrupt, oldest, file=_tail("_metadata.file_path")
    )
    return rows.where(wanted)


def taken_files(table: RunTable, live: list[Run]) -> DataFrame:
    """`name, date, file`: the files whose rows are in the given runs, by folder and name.

    A run of one date answers for the files of that date, a run without a part for all it lists.
    """
    pairs = table.spark.createDataFrame([(r.name, r.part) for r in live], "run string, part string")
    listed = table.read_beside(live, TAKEN, BESIDE)
    own = (F.col("name") == F.col("run")) & F.col("part").isin("", F.col("date"))
    return listed.join(F.broadcast(pairs), own, "left_semi")


def pin_new_files(
    spark: SparkSession, path: str, table: RunTable, live: list[Run], name: str, date: str | None = None
) -> tuple[DataFrame, str]:
    """`name, date, file` of the files, of one date or of all, that no live run has taken, for a
    run `name`; written down, so that what comes meanwhile is left for the next time. And the
    name under which they are stored."""
    pinned = new_name()
    fresh = not_taken(spark, path, taken_files(table, live))
    wanted = F.col("date").isNotNull() if date is None else F.col("date") == date
    listing = table.folder(pinned, BESIDE)
    fresh.where(wanted).select(F.lit(name).alias("name"), "date", "file", "modified").write.parquet(
        listing
    )
    return spark.read.schema(TAKEN).parquet(listing), pinned


def not_taken(spark: SparkSession, path: str, taken: DataFrame) -> DataFrame:
    """`file, date, modified` of the lake's files that are not among `taken`; none is opened.

    The names come from Spark's own list of files, so that the log of a streaming writer
    decides which of them count. A lake without date folders has null dates.
    """
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    listing = listing.option("pathGlobFilter", "*.parquet")
    none = schemas.record(path=schemas.STRING, modificationTime=schemas.TIMESTAMP)
    names = or_empty(spark, lambda: listing.load(path), none)
    date = F.regexp_extract("file", r"date=(\d{4}-\d{2}-\d{2})/", 1)
    return (
        names.select(_tail("path").alias("file"), F.col("modificationTime").alias("modified"))
        .select("file", F.nullif(date, F.lit("")).alias("date"), "modified")
        .join(taken, "file", "left_anti")
    )


def rows_of_files(spark: SparkSession, path: str, names: DataFrame) -> DataFrame:
    """The rows that are in the files `names`."""
    dates = names.groupBy("date").agg(F.min("modified").alias("since")).collect()
    if not dates:
        return spark.createDataFrame([], schemas.READING)
    return _files_since(spark, path, dates, False).join(names, "file", "left_semi").drop("file")


def _tail(column: str) -> Column:
    """Folder and name of a file, the same however a path is spelled."""
    return F.substring_index(column, "/", -2)


def read_latest_partition(
    spark: SparkSession, path: str, skip_corrupt: bool = False, compacted: str | None = None
) -> DataFrame:
    """Readings of the newest date that has any.

    In a lake without folders of dates, the date column decides; without one either, all
    readings count as one partition.
    """
    if compacted is not None:
        lake = read_compacted_lake(spark, path, compacted, skip_corrupt)
        return lake.where(F.col("date").eqNullSafe(lake.select(F.max("date")).scalar()))
    lake = _scan_lake(spark, path, skip_corrupt)
    found = newest_date(lake)
    newest = F.lit(found).cast("date") if found else lake.select(F.max("date")).scalar()
    return _with_time(lake.where(F.col("date").eqNullSafe(newest)))


def files_without_rows(spark: SparkSession, path: str, date: str | None = None) -> DataFrame:
    """`file, date` of the lake's files that give no reading when corrupt ones are skipped: those
    that cannot be read, and empty ones. Of one date, or of all."""
    listed = not_taken(spark, path, spark.createDataFrame([], TAKEN))
    if listed.isEmpty():
        return listed.select("file", "date")
    read = _scan_lake(spark, path, True, file=_tail("_metadata.file_path"))
    if date is not None:
        listed = listed.where(F.col("date") == date)
        read = read.where(F.col("date") == F.lit(date).cast("date"))
    return listed.join(read.select("file").distinct(), "file", "left_anti").select("file", "date")


def dates_of(lake: DataFrame) -> list[str]:
    """Dates that the lake's folders are named after, newest first; no file is opened.

    The names come from Spark's own list of files, so that the log of a streaming writer
    decides which of them count.
    """
    found = (DATE_FOLDER.search(name) for name in lake.inputFiles())
    return sorted({match[1] for match in found if match}, reverse=True)


def newest_date(lake: DataFrame) -> str | None:
    """The newest date with a reading, None for a lake without dates."""
    for date in dates_of(lake):
        if not _with_time(lake.where(F.col("date") == F.lit(date).cast("date"))).isEmpty():
            return date
    return None


def _scan_lake(
    spark: SparkSession, path: str, skip_corrupt: bool, since: Column | None = None, **more: Column
) -> DataFrame:
    """Readings as they are, of files changed at `since` or later, and columns `more` of files."""
    reader = spark.read.schema(schemas.READING)
    reader = reader.option("ignoreCorruptFiles", str(skip_corrupt).lower())
    lake = or_empty(spark, lambda: reader.parquet(path), schemas.READING)
    if since is not None:
        lake = lake.where(F.col("_metadata.file_modification_time") >= since)
    return lake.select(*schemas.READING.names, *(c.alias(name) for name, c in more.items()))


def _with_time(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("event_time").isNotNull())


def read_predictions(
    spark: SparkSession, path: str, since: Column | None = None
) -> DataFrame:
    """Predictions under `path`, without lines that do not parse or have no time.

    With `since`, folders of earlier dates are not read; later rows of that date still need a
    filter. A folder without dates is read whole.
    """
    schema = StructType([*schemas.PREDICTION, *StructType().add("date", "date")])
    reader = (
        spark.read.schema(schema)
        .option("mode", "DROPMALFORMED")
        .option("pathGlobFilter", "part-*.json")
    )
    rows = or_empty(spark, lambda: reader.json(path), schema)
    if since is not None:
        rows = rows.where(F.col("date").isNull() | (F.col("date") >= F.to_date(since)))
    return _with_time(rows).select(*schemas.PREDICTION.names)


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """Historical readings from CSV files with a header, all with the same columns.

    Columns the files lack get their defaults, a value that does not parse is NULL. No rows
    if there are no files.
    """
    return shape.align_history(
        or_empty(
            spark, lambda: spark.read.csv(path, header=True, enforceSchema=False), schemas.HISTORY
        )
    )


def read_stream_of(
    spark: SparkSession, folder: str, schema: StructType, name: str | None = None
) -> DataFrame:
    """A stream of the Parquet files in `folder`, or of the one file `name` in it."""
    reader = spark.readStream.schema(schema)
    if name:
        reader = reader.option("pathGlobFilter", re.sub(r"([*?\[\]{}\\])", r"\\\1", name))
    return reader.parquet(folder)
