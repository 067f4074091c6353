"""Tables made of immutable runs, with a log that says which of them count.

A run is a folder that is written once. A change of the table writes a new version of its log:
all runs of one owner that count from then on. Readers take the newest version of every owner,
so a change appears as a whole or not at all, and a run whose writer failed never counts. An
owner has one writer at a time; owners do not disturb each other.

Sizes stay geometric: `to_merge` names the newest runs that a new one should take in, so that
the runs of a part number about the logarithm of their rows, and a row is rewritten as often.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

from meterlake import schemas

# A run takes in its older neighbour unless that is at least so many times larger.
GROWTH = 2
# Versions of the log that stay for readers that have begun.
KEPT_VERSIONS = 3
# Where the files are listed that the rows of a run came from.
BESIDE = "taken"

LOG = schemas.record(
    owner=schemas.STRING,
    version=schemas.LONG,
    name=schemas.STRING,
    part=schemas.STRING,
    rows=schemas.LONG,
    last=schemas.LONG,
    live=schemas.BOOLEAN,
)


@dataclass(frozen=True)
class Run:
    """Rows of one part of the table, written at once; `last` orders the runs of a part.

    A part that is a date has a folder of its own, beside those that were written with it.
    """

    name: str
    part: str
    rows: int
    last: int


def new_name() -> str:
    return uuid.uuid4().hex


class RunTable:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def live(self, owner: str | None = None) -> list[Run]:
        """Runs that count, of one owner or of all; a few for each part."""
        return [_run(row) for row in self._newest(owner) if row.live]

    def folder(self, name: str, kind: str = "rows") -> str:
        return f"{self.root}/{kind}/run={name}"

    def rows_folder(self, run: Run) -> str:
        return f"{self.folder(run.name)}/date={run.part}" if run.part else self.folder(run.name)

    def read(self, runs: Iterable[Run], schema: StructType) -> DataFrame:
        return self._parquet([self.rows_folder(run) for run in runs], schema, "rows")

    def read_beside(self, runs: Iterable[Run], schema: StructType, kind: str) -> DataFrame:
        """What was stored beside the rows of these runs."""
        names = sorted({run.name for run in runs})
        return self._parquet([self.folder(name, kind) for name in names], schema, kind)

    def _parquet(self, paths: list[str], schema: StructType, kind: str) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.schema(schema).option("basePath", f"{self.root}/{kind}")
        return reader.parquet(*paths).select(*schema.names)

    def write(self, rows: DataFrame, last: int) -> Run:
        """Store rows as a run of a table without parts; it does not count yet."""
        name = new_name()
        rows.write.parquet(self.folder(name))
        stored = self.spark.read.schema(rows.schema).parquet(self.folder(name))
        return Run(name, "", stored.count(), last)

    def commit(self, owner: str, add: Iterable[Run], drop: Iterable[Run] = ()) -> None:
        """From now on the runs of `add` count, those of `drop` no longer.

        Dropped folders stay until the next commit, for readers of the version before.
        """
        before, dropped = self._newest(owner), set(drop)
        version = 1 + max((row.version for row in before), default=0)
        states = [(run, run not in dropped) for run in [*(_run(r) for r in before if r.live), *add]]
        log = [(owner, version, r.name, r.part, r.rows, r.last, counts) for r, counts in states]
        if not log:
            return
        frame = self.spark.createDataFrame(log, LOG).coalesce(1)
        frame.write.mode("overwrite").json(self._version(owner, version))
        used = {run.name for run, _ in states}
        for run in (_run(row) for row in before if not row.live):
            remove(self.spark, self.rows_folder(run))
            if run.name not in used:
                self.discard(run.name)
        remove(self.spark, self._version(owner, version - KEPT_VERSIONS))

    def discard(self, name: str) -> None:
        for kind in ("rows", BESIDE):
            remove(self.spark, self.folder(name, kind))

    def _version(self, owner: str, version: int) -> str:
        return f"{self.root}/log/{owner}/{version:012d}"

    def _newest(self, owner: str | None) -> list[Row]:
        path = f"{self.root}/log" if owner is None else f"{self.root}/log/{owner}"
        reader = self.spark.read.schema(LOG).option("recursiveFileLookup", "true")
        log = or_empty(self.spark, lambda: reader.json(path), LOG)
        newest = F.max("version").over(Window.partitionBy("owner"))
        rows = log.withColumn("newest", newest).where("version = newest").drop("newest")
        return sorted(rows.collect(), key=lambda row: (row.owner, row.part, row.last))


def _run(row: Row) -> Run:
    return Run(row.name, row.part, row.rows, row.last)


def to_merge(runs: list[Run], rows: int) -> list[Run]:
    """The newest of a part's runs that a new run of so many rows should take in."""
    taken: list[Run] = []
    for run in sorted(runs, key=lambda run: run.last, reverse=True):
        if run.rows >= GROWTH * rows:
            break
        taken.append(run)
        rows += run.rows
    return taken


def or_empty(spark: SparkSession, read, schema: StructType) -> DataFrame:
    """What `read` gives, or no rows if there is no such path yet."""
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder wherever Spark can write one; nothing happens if there is none."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
