"""The power model from stored sums, so that training reads only new files of the lake.

A linear fit needs of its rows their number, the sums of all features and the label, and the
sums of their products. These add up, exactly as whole numbers, over files, dates and runs.
"""

from __future__ import annotations

import itertools

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from meterlake import schemas
from meterlake.functions import measures
from meterlake.plans import model as power_model
from meterlake.sources import files, runs

COLUMNS = [*schemas.FEATURES, schemas.LABEL]
PAIRS = list(itertools.combinations_with_replacement(COLUMNS, 2))
# Decimals of all columns that count.
DIGITS = 4
WHOLE = "decimal(38,0)"


def sum_names() -> list[str]:
    return ["n", *(f"sum_{c}" for c in COLUMNS), *(f"sum_{a}_{b}" for a, b in PAIRS)]


MOMENTS = "date date, " + ", ".join(f"{name} {WHOLE}" for name in sum_names())


def moments(readings: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Count, sums and sums of products of the training rows of every date, in whole units."""
    rows = readings.select("date", *COLUMNS).dropna("any", subset=COLUMNS)
    units = rows.select("date", *(measures.whole_units(F.col(c), digits).cast(WHOLE).alias(c) for c in COLUMNS))
    # A product of two units may not fit 64 bits when it is summed.
    products = [_total(F.col(a) * F.col(b)).alias(f"sum_{a}_{b}") for a, b in PAIRS]
    sums = [_total(F.col(c)).alias(f"sum_{c}") for c in COLUMNS]
    return units.dropna("any", subset=COLUMNS).groupBy("date").agg(
        F.count("*").cast(WHOLE).alias("n"), *sums, *products
    )


def added_up(parts: DataFrame, *by: str) -> DataFrame:
    return parts.groupBy(*by).agg(*(_total(F.col(name)).alias(name) for name in sum_names()))


def _total(value: Column) -> Column:
    return F.sum(value.cast("decimal(28,0)")).cast(WHOLE)


def update(spark: SparkSession, lake: str, target: str, digits: int = DIGITS) -> int:
    """Add the lake's new files to the sums in `target`; the number of training rows in them.

    Runs and the files they came from appear together, as in a compaction, so every reading
    counts once, however late its file comes. One update runs at a time.
    """
    table, name = runs.RunTable(spark, target), runs.new_name()
    live = table.live()
    names, pinned = files.pin_new_files(spark, lake, table, live, name)
    dates = [row.date for row in names.select("date").distinct().collect()]
    rows = 0
    if dates:
        schema = stored_schema(spark)
        fresh = moments(files.rows_of_files(spark, lake, names), digits)
        merged = runs.to_merge(live, len(dates))
        parts = fresh.unionByName(table.read(merged, schema))
        added_up(parts, "date").coalesce(1).write.parquet(table.folder(name))
        earlier = files.taken_files(table, merged).withColumn("name", F.lit(name))
        names.unionByName(earlier).coalesce(1).write.parquet(table.folder(name, runs.BESIDE))
        order = 1 + max((run.last for run in live), default=0)
        size = len(dates) + sum(run.rows for run in merged)
        rows = _rows(table, [runs.Run(name, "", size, order)]) - _rows(table, merged)
        table.commit("moments", [runs.Run(name, "", size, order)], merged)
    table.discard(pinned)
    return rows


def stored_schema(spark: SparkSession):
    return spark.createDataFrame([], MOMENTS).schema


def _rows(table: runs.RunTable, some: list[runs.Run]) -> int:
    return int(table.read(some, stored_schema(table.spark)).agg(F.sum("n")).first()[0] or 0)


def fit(spark: SparkSession, target: str, digits: int = DIGITS) -> PipelineModel | None:
    """The model of all rows that `update` has seen; None if there are none.

    Only the sums, one row, reach the driver, where they are solved. The model is then fitted to
    a few points on the plane found: the mean, and a step to either side of it along every
    feature. A feature with one value only, or that follows from others, does not count beside
    them.
    """
    table = runs.RunTable(spark, target)
    total = added_up(table.read(table.live(), stored_schema(spark))).first()
    n = int(total.n or 0)
    if not n:
        return None
    sums = [int(total[f"sum_{c}"]) for c in COLUMNS]
    spread = np.zeros((len(COLUMNS),) * 2)
    for (i, a), (j, b) in itertools.combinations_with_replacement(list(enumerate(COLUMNS)), 2):
        # Exact before the division: the differences are small beside the sums.
        spread[i, j] = spread[j, i] = (n * int(total[f"sum_{a}_{b}"]) - sums[i] * sums[j]) / n**2
    mean = np.array([s / n for s in sums]) / 10.0**digits
    step = np.sqrt(np.diag(spread)[:-1])
    step[step == 0] = 10.0**digits  # the weight of such a feature is 0
    weights = np.linalg.pinv(spread[:-1, :-1] / np.outer(step, step), 1e-12) @ (spread[:-1, -1] / step)
    moves = np.diag(step) / 10.0**digits
    rises = weights / 10.0**digits
    points = [
        tuple(map(float, [*(mean[:-1] + side * move), mean[-1] + side * rise]))
        for move, rise in zip(moves, rises)
        for side in (-1, 1)
    ]
    return power_model.train(spark.createDataFrame(points, COLUMNS))


def train_and_save(
    spark: SparkSession, lake: str, target: str, model_path: str, digits: int = DIGITS
) -> PipelineModel | None:
    """Add what is new in the lake, fit, and replace the saved model."""
    update(spark, lake, target, digits)
    found = fit(spark, target, digits)
    if found is not None:
        power_model.save(found, model_path)
    return found
