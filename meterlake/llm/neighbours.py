"""Approximate nearest neighbours along shifted space-filling curves.

Each curve projects the vectors to a few random directions, shifts them, and orders them by
their place on a Hilbert curve. Spark sorts the vectors of every curve into ranges, so that a
vector has a position. A query is compared with the vectors at most a fixed share of the table
away on each of the curves; the windows of all curves are merged and ranked by exact cosine.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from meterlake.llm.common import stored, table

NEAREST = 5
QUERY_STEP = 50
CURVES = 24
DIMENSIONS = 12
BITS = 3
# Part of the table that a query meets on one curve, half of it on either side.
WINDOW_SHARE = 0.04
# Rows on either side that a window has at least: small tables have looser neighbours.
LEAST_ROWS = 200
# Rows that fit the centre and spread of the projections.
FIT_ROWS = 2000
BLOCK_ROWS = 2000
RESULT = "query_id long, rank int, vec_id long, score double"


@dataclass(frozen=True)
class Curves:
    """Projection, centre, spread and shift of every curve, side by side."""

    directions: np.ndarray
    centre: np.ndarray
    spread: np.ndarray
    shift: np.ndarray
    curves: int
    bits: int

    def keys(self, vectors: np.ndarray) -> np.ndarray:
        """Hilbert keys, a row per curve."""
        unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
        placed = (unit @ self.directions - self.centre) / self.spread + self.shift
        cells = np.clip((placed + 3) / 6 * (1 << self.bits), 0, (1 << self.bits) - 1)
        split = np.split(cells.astype(np.int64), self.curves, axis=1)
        return np.stack([hilbert_keys(part, self.bits) for part in split])


def fit_curves(sample: np.ndarray, curves: int, dimensions: int, bits: int) -> Curves:
    draw = np.random.default_rng(7)
    size = sample.shape[1]
    dimensions = min(dimensions, size)
    directions = np.hstack(
        [np.linalg.qr(draw.normal(size=(size, size)))[0][:, :dimensions] for _ in range(curves)]
    )
    placed = sample / np.linalg.norm(sample, axis=1, keepdims=True) @ directions
    shift = draw.uniform(-0.5, 0.5, directions.shape[1])
    return Curves(directions, placed.mean(0), placed.std(0) + 1e-9, shift, curves, bits)


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place of integer points on the Hilbert curve (Skilling, 2004: from axes to transpose)."""
    axes = cells.T.copy()
    top = 1 << (bits - 1)
    level = top
    while level > 1:
        low = level - 1
        for axis in range(len(axes)):
            set_here = (axes[axis] & level) != 0
            swap = np.where(set_here, 0, (axes[0] ^ axes[axis]) & low)
            axes[0] = np.where(set_here, axes[0] ^ low, axes[0] ^ swap)
            axes[axis] ^= swap
        level >>= 1
    for axis in range(1, len(axes)):
        axes[axis] ^= axes[axis - 1]
    flips = np.zeros_like(axes[0])
    level = top
    while level > 1:
        flips = np.where((axes[-1] & level) != 0, flips ^ (level - 1), flips)
        level >>= 1
    axes ^= flips
    keys = np.zeros_like(axes[0])
    for bit in range(bits - 1, -1, -1):
        for axis in axes:
            keys = (keys << 1) | ((axis >> bit) & 1)
    return keys


def usable(vectors: DataFrame) -> DataFrame:
    """`vec_id, vector` of vectors that have a direction, in double precision."""
    finite = F.forall(
        "vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    return (
        vectors.select(
            F.col("vec_id").cast("long").alias("vec_id"),
            F.col("embedding").cast("array<double>").alias("vector"),
        )
        .where(F.col("vec_id").isNotNull() & (F.size("vector") > 0) & finite)
        .where(F.exists("vector", lambda x: x != 0))
    )


def nearest(
    vectors: DataFrame,
    k: int = NEAREST,
    query_step: int = QUERY_STEP,
    curves: int = CURVES,
    dimensions: int = DIMENSIONS,
    bits: int = BITS,
    window_share: float = WINDOW_SHARE,
    least_rows: int = LEAST_ROWS,
    fit_rows: int = FIT_ROWS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """`query_id, rank, vec_id, score`: up to `k` nearest others of every query, by cosine.

    Queries are the rows whose vec_id is divisible by `query_step`. Ties go to the smaller
    vec_id. Null, zero and non-finite vectors and null ids take no part; without another
    vector a query has no row. Equal vectors are searched as one: the `k + 1` smallest ids of
    each are enough to fill any result. Rows that repeat a vec_id count once per vector. Vectors
    are compared with those of their own size, a search for each size. Other columns are ignored,
    whatever their names.
    """
    rows = usable(vectors).distinct()
    is_query = F.col("vec_id") % query_step == 0
    size = F.size("vector").alias("size")
    # Equal vectors, however many, are combined in each task before they meet.
    merged = stored(
        rows.groupBy("vector").agg(F.min("vec_id").alias("id"), F.max(is_query).alias("asked")),
        "vectors",
    )
    members = rows.join(merged.select("vector", "id"), "vector").select("id", "vec_id", size)
    members = stored(members, "members")
    # One number for each size of vector.
    counts = merged.groupBy(size).count().collect()
    result = rows.sparkSession.createDataFrame([], RESULT)
    for own, total in counts:
        half = max(least_rows, k + 1, int(np.ceil(window_share * total / 2)))
        same = merged.where(size == own).drop("size")
        # Bound: fit_rows vectors.
        sample = same.orderBy(F.xxhash64("id"), "id").limit(fit_rows).select("vector").collect()
        fitted = fit_curves(np.array([row[0] for row in sample]), curves, dimensions, bits)
        found = compare_blocks(positions(same, fitted), half, block_rows, k + 1)
        there = members.where(F.col("size") == own).drop("size")
        result = result.unionByName(of_members(found, there, is_query, k))
    return result


def of_members(found: DataFrame, members: DataFrame, is_query: Column, k: int) -> DataFrame:
    """The first `k` rows of every query, from the best vectors of every distinct vector."""
    best = top(found.groupBy("query", "id").agg(F.max("score").alias("score")), "query", "id", k + 1)
    smallest = (
        members.withColumn("n", F.row_number().over(Window.partitionBy("id").orderBy("vec_id")))
        .where(F.col("n") <= k + 1)
        .select("id", "vec_id")
    )
    asked = members.where(is_query).select(F.col("id").alias("query"), F.col("vec_id").alias("query_id"))
    pairs = (
        best.join(smallest, "id")
        .join(asked, "query")
        .where("vec_id <> query_id")
        .select("query_id", "vec_id", "score")
    )
    return top(pairs, "query_id", "vec_id", k).select(
        "query_id", F.col("n").alias("rank"), "vec_id", "score"
    )


def top(pairs: DataFrame, by: str, tie: str, n: int) -> DataFrame:
    """The first `n` of each group; every task keeps only its own first ones beforehand."""
    order = Window.partitionBy(by).orderBy(F.desc("score"), tie)
    return pairs.withColumn("n", F.row_number().over(order)).where(F.col("n") <= n)


def positions(merged: DataFrame, fitted: Curves) -> DataFrame:
    """`curve, position, id, vector, asked`: the place of every vector on every curve."""

    def keyed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                for curve, keys in enumerate(fitted.keys(np.stack(batch["vector"]))):
                    yield batch.assign(curve=np.int32(curve), key=keys)

    keys = merged.mapInPandas(keyed, "vector array<double>, id long, asked boolean, curve int, key long")
    ranged = stored(
        keys.repartitionByRange("curve", "key", "id")
        .sortWithinPartitions("curve", "key", "id")
        .withColumn("part", F.spark_partition_id())
        .withColumn("row", F.monotonically_increasing_id()),
        "curves",
    )
    # One row per range and curve: a bounded table, whatever the rows.
    parts = ranged.groupBy("curve", "part").agg(F.min("row").alias("first"), F.count("*").alias("n"))
    before = Window.partitionBy("curve").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    return ranged.join(F.broadcast(parts.drop("n")), ["curve", "part"]).select(
        "curve", (F.col("before") + F.col("row") - F.col("first")).alias("position"), "id",
        "vector", "asked",
    )


def compare_blocks(placed: DataFrame, half: int, block_rows: int, keep: int) -> DataFrame:
    """`query, id, score`: the best of each block of positions for the queries near it.

    A query goes to the blocks its window touches, so neither a task nor a window limits the
    other. Rows of a block and queries are brought together by block.
    """
    blocks = placed.withColumn("block", F.floor(F.col("position") / block_rows))
    first = F.floor(F.greatest(F.col("position") - half, F.lit(0)) / block_rows)
    last = F.floor((F.col("position") + half) / block_rows)
    queries = placed.where("asked").select(
        F.col("curve").alias("q_curve"), F.explode(F.sequence(first, last)).alias("q_block"),
        F.col("position").alias("q_position"), F.col("id").alias("query"),
        F.col("vector").alias("q_vector"),
    )

    def best(rows: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if not len(rows) or not len(asked):
            return pd.DataFrame({"query": [], "id": [], "score": []})
        there, ids = np.stack(rows["vector"]), rows["id"].to_numpy()
        lengths = np.sqrt((there * there).sum(1))
        at, parts = rows["position"].to_numpy(), []
        for start in range(0, len(asked), 500):
            part = asked.iloc[start : start + 500]
            here = np.stack(part["q_vector"])
            own = np.sqrt((here * here).sum(1))
            near = here @ there.T / (own[:, None] * lengths)
            near[np.abs(part["q_position"].to_numpy()[:, None] - at) > half] = -np.inf
            few = np.argsort(-near, axis=1, kind="stable")[:, : keep + 3]
            # The same sum for a pair in whatever block it is met.
            exact = (here[:, None, :] * there[few]).sum(2) / (own[:, None] * lengths[few])
            seen = np.isfinite(np.take_along_axis(near, few, 1))
            query = np.repeat(part["query"].to_numpy(), few.shape[1]).reshape(few.shape)
            parts.append(
                pd.DataFrame({"query": query[seen], "id": ids[few][seen], "score": exact[seen]})
            )
        return pd.concat(parts)

    return (
        blocks.groupBy("curve", "block")
        .cogroup(queries.groupBy("q_curve", "q_block"))
        .applyInPandas(best, "query long, id long, score double")
    )


def query(spark, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"))
