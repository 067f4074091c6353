"""Hard negatives from vectors, by lists of candidates that clusters of anchors share.

Anchors are taken in rounds of a bounded number and clustered by direction. A cluster knows its
centre and the widest angle of a member to it. Every task holds some of the rows and sorts them
once per cluster by the largest inner product that a member of length one could have with each:
its length times the cosine of its angle to the centre less that widest angle. All members walk
that one list, and a member leaves it when the bound, times its own length, is certain to be
below all that it still looks for.

A round has two searches: the anchors' positives, and with their scores the negatives. Each
walks a share of the rows first; the scores found there are what a member needs from the rest,
so that tasks end their walks early and send little.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from meterlake.llm.common import stored, table

POSITIVES, NEGATIVES = 5, 10
ANCHOR_STEP, RELABEL_STEP, LABELS, SCALE = 100, 7, 10, 256
# A negative's score is between these percentages of the positive's.
LOW, HIGH = 30, 90
# Components of the anchors of a round, which are broadcast.
ROUND_COMPONENTS = 1_000_000
# One row in so many is walked first.
FIRST_SHARE = 32
# Rows that share a list in a task, and those that members take from it at a step.
LIST_ROWS, STEP_ROWS = 8192, 512
# Scores stay below 2^53, so that sums of products in doubles are exact.
LARGEST_SQUARE = float(1 << 53)
ANYTHING = 1 << 60
# Above all rounding of angles and of bounds.
ANGLE_SLACK, BOUND_SLACK = 1e-6, 1e-9

FOUND = "anchor long, goal long, id long, score long"
RESULT = (
    "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, "
    "negative_score long"
)


def usable(vectors: DataFrame) -> DataFrame:
    """`id, label, vector` of the rows that take part: whole components and changed labels."""
    scaled = F.transform("embedding", lambda x: x * SCALE)
    small = F.forall("scaled", lambda x: x.isNotNull() & (F.abs(x) < LARGEST_SQUARE))
    square = F.aggregate("vector", F.lit(0.0), lambda total, x: total + x * x.cast("double"))
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % RELABEL_STEP == 0, (label + 1) % LABELS).otherwise(label)
    return (
        vectors.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("embedding"))
        .where("vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL")
        .select(F.col("vec_id").cast("long").alias("id"), moved.alias("label"), scaled.alias("scaled"))
        .where(small)
        .select("id", "label", F.transform("scaled", lambda x: F.floor(x).cast("long")).alias("vector"))
        .where(square < LARGEST_SQUARE)
    )


@dataclass(frozen=True)
class Cluster:
    """Anchors of one vector size that share lists of candidates."""

    numbers: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    lengths: np.ndarray
    centre: np.ndarray
    widest: float

    def bounds(self, vectors: np.ndarray) -> np.ndarray:
        """The largest inner product of each row with a member, were its length one."""
        lengths = np.sqrt((vectors * vectors).sum(1))
        angle = angles(vectors, lengths, self.centre) - self.widest
        return lengths * np.cos(np.maximum(angle, 0.0))


def angles(vectors: np.ndarray, lengths: np.ndarray, centre: np.ndarray) -> np.ndarray:
    """To the centre; 0, the most careful, for a vector of length 0."""
    cosine = vectors @ centre / np.where(lengths > 0, lengths, 1.0)
    return np.where(lengths > 0, np.arccos(np.clip(cosine, -1.0, 1.0)), 0.0)


def clusters_of(numbers: np.ndarray, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> list[Cluster]:
    """About as many clusters as a cluster has members, by a few rounds of mean directions."""
    lengths = np.sqrt((vectors * vectors).sum(1))
    units = vectors / np.where(lengths > 0, lengths, 1.0)[:, None]
    centres = units[np.linspace(0, len(ids) - 1, max(1, int(np.sqrt(len(ids))))).astype(int)]
    for _ in range(8):
        nearest = (units @ centres.T).argmax(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, units)
        size = np.sqrt((sums * sums).sum(1))[:, None]
        centres = np.where(size > 0, sums / np.where(size > 0, size, 1.0), centres)
    nearest, found = (units @ centres.T).argmax(1), []
    for number in np.unique(nearest):
        own = nearest == number
        widest = angles(vectors[own], lengths[own], centres[number]).max() + ANGLE_SLACK
        found.append(
            Cluster(numbers[own], ids[own], labels[own], vectors[own], lengths[own], centres[number], widest)
        )
    return found


class Goal:
    """The first `k` rows, by score and then by id, with scores from `low` to `high`.

    Rows of the anchor's own label, or of any other. `bar` is the score that is known to be
    needed; the same id with the same score counts once.
    """

    def __init__(self, k: int, name: int, own: bool, low: int = -ANYTHING, high: int = ANYTHING):
        self.k, self.name, self.own, self.high = k, name, own, high
        self.bar = low
        self.scores, self.ids = np.empty(0, np.int64), np.empty(0, np.int64)

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        fits = (scores >= self.bar) & (scores <= self.high)
        if not fits.any():
            return
        scores, ids = np.append(self.scores, scores[fits]), np.append(self.ids, ids[fits])
        order = np.lexsort((ids, -scores))
        scores, ids = scores[order], ids[order]
        new = np.append(True, (np.diff(scores) != 0) | (np.diff(ids) != 0))
        self.scores, self.ids = scores[new][: self.k], ids[new][: self.k]
        if len(self.scores) == self.k:
            self.bar = int(self.scores[-1])


# Goals of an anchor, by its number, label aside.
Goals = Callable[[int], list[Goal]]


class Walk:
    """One cluster in one task: the goals of its members."""

    def __init__(self, cluster: Cluster, goals_of: Goals):
        self.cluster = cluster
        self.goals = [goals_of(number) for number in cluster.numbers.tolist()]
        self.needs = np.array([self.need(member) for member in range(len(self.goals))], float)
        self.products = 0  # computed so far

    def need(self, member: int) -> float:
        return min((goal.bar for goal in self.goals[member] if goal.bar <= goal.high), default=np.inf)

    def along(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> None:
        """All members along the list of these candidates, in the order of the bounds."""
        bounds = self.cluster.bounds(vectors)
        order = np.argsort(-bounds, kind="stable")
        for start in range(0, len(order), STEP_ROWS):
            # Certain: nothing that follows on the list has a larger product with the member.
            most = self.cluster.lengths * bounds[order[start]]
            on_way = np.flatnonzero(most + np.abs(most) * BOUND_SLACK + BOUND_SLACK >= self.needs)
            if not len(on_way):
                return
            step = order[start : start + STEP_ROWS]
            products = self.cluster.vectors[on_way] @ vectors[step].T
            self.products += products.size
            for member, row in zip(on_way.tolist(), products):
                near = np.flatnonzero(row >= self.needs[member])
                if len(near):
                    self.take(member, ids[step[near]], labels[step[near]], row[near].astype(np.int64))

    def take(self, member: int, ids: np.ndarray, labels: np.ndarray, scores: np.ndarray) -> None:
        same = labels == self.cluster.labels[member]
        own, other = same & (ids != self.cluster.ids[member]), ~same
        for goal in self.goals[member]:
            fits = own if goal.own else other
            goal.add(scores[fits], ids[fits])
        self.needs[member] = self.need(member)

    def rows(self) -> Iterator[tuple[int, int, int, int]]:
        for number, goals in zip(self.cluster.numbers.tolist(), self.goals):
            for goal in goals:
                for score, other in zip(goal.scores.tolist(), goal.ids.tolist()):
                    yield number, goal.name, other, score


def walked(rows: DataFrame, clusters: list[Cluster], goals_of: Goals) -> DataFrame:
    """`anchor, goal, id, score`: what the members of all clusters find in each task."""
    shared = rows.sparkSession.sparkContext.broadcast((clusters, goals_of))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        clusters, goals_of = shared.value
        walks = [Walk(cluster, goals_of) for cluster in clusters]
        for batch in batches:
            for start in range(0, len(batch), LIST_ROWS):
                part = batch.slice(start, LIST_ROWS)
                sizes = part.column("vector").value_lengths().to_numpy()
                for size in np.unique(sizes):
                    same = part.filter(pa.array(sizes == size))
                    candidates = columns_of(same, size)
                    for walk in walks:
                        if walk.cluster.vectors.shape[1] == size:
                            walk.along(*candidates)
        found = [row for walk in walks for row in walk.rows()]
        for start in range(0, len(found), 100_000):
            columns = zip(*found[start : start + 100_000])
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], ["anchor", "goal", "id", "score"]
            )

    return rows.mapInArrow(search, FOUND)


def columns_of(batch: pa.RecordBatch | pa.Table, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, labels and vectors; whole numbers in doubles, whose products add up exactly."""
    ids, labels = (batch.column(c).to_numpy() for c in ("id", "label"))
    values = batch.column("vector").combine_chunks() if isinstance(batch, pa.Table) else batch.column("vector")
    return ids, labels, values.flatten().to_numpy().astype(np.float64).reshape(len(ids), size)


def first_of(found: DataFrame, k: int) -> DataFrame:
    """The first `k` of every anchor and goal, `rank` from 1; tasks keep their own first ones."""
    order = Window.partitionBy("anchor", "goal").orderBy(F.desc("score"), "id")
    return found.distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


@dataclass(frozen=True)
class OwnLabel:
    """One goal for every anchor: the best other rows of its label."""

    k: int
    bars: dict[tuple[int, int], int]

    def __call__(self, number: int) -> list[Goal]:
        return [Goal(self.k, 0, True, self.bars.get((number, 0), -ANYTHING))]


@dataclass(frozen=True)
class OtherLabels:
    """A goal for every score of a positive: the best other-label rows in its range."""

    k: int
    bars: dict[tuple[int, int], int]
    scores: dict[int, list[int]]

    def __call__(self, number: int) -> list[Goal]:
        goals = []
        for score in self.scores.get(number, ()):
            low, high = -(-LOW * score // 100), HIGH * score // 100
            if low <= high:
                goals.append(Goal(self.k, score, False, max(low, self.bars.get((number, score), low)), high))
        return goals


def found_in_two_walks(rows: DataFrame, clusters: list[Cluster], goals_of: Callable, k: int) -> DataFrame:
    """The first `k` of every goal over all rows, stored; `goals_of(bars)` gives the goals."""
    early = F.pmod(F.xxhash64("id"), F.lit(FIRST_SHARE)) == 0
    first = stored(first_of(walked(rows.where(early), clusters, goals_of({})), k), "first")
    # At most one for each goal of the round.
    bars = {(r.anchor, r.goal): r.score for r in first.where(F.col("rank") == k).collect()}
    rest = walked(rows.where(~early), clusters, goals_of(bars))
    return stored(first_of(first.drop("rank").unionByName(rest), k), "found")


def mine(
    vectors: DataFrame,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    anchor_step: int = ANCHOR_STEP,
    round_components: int = ROUND_COMPONENTS,
) -> DataFrame:
    """`anchor_id, positive_id, rank, negative_id, positive_score, negative_score`.

    `vectors` has `vec_id, embedding, label`; other columns are ignored, whatever their names.
    Anchors are rows whose vec_id is divisible by `anchor_step`, positives their first other
    rows of the same label by inner product, negatives the first rows of other labels whose
    score is 30 to 90 percent of the positive's. Ties go to the smaller vec_id.

    Rows with a null id, label, vector or component and non-finite vectors take no part, nor
    those of a scaled length of 2^26.5 or more, whose scores doubles do not hold exactly. Only
    vectors of equal size have a product. Rows that repeat a vec_id are rows of their own; the
    same id with the same score counts once for an anchor. An anchor without a positive, and a
    positive without a negative, has no rows; a table without rows gives none.
    """
    spark = vectors.sparkSession
    rows = stored(usable(vectors), "rows")
    anchors = stored(rows.where(F.col("id") % anchor_step == 0).distinct(), "anchors")
    rounds = -(-(anchors.agg(F.sum(F.size("vector") + 1)).first()[0] or 0) // round_components)
    result = spark.createDataFrame([], RESULT)
    for number in range(rounds):
        part = F.pmod(F.xxhash64("id", "vector"), F.lit(rounds)) == number
        asked = anchors.where(part).toArrow()  # about `round_components` components
        if len(asked):
            result = result.unionByName(mine_round(rows, asked, positives, negatives))
    return result


def mine_round(rows: DataFrame, asked: pa.Table, positives: int, negatives: int) -> DataFrame:
    spark = rows.sparkSession
    asked = asked.append_column("number", pa.array(range(len(asked)), pa.int64()))
    sizes = np.array([len(v) for v in asked.column("vector")])
    clusters = []
    for size in np.unique(sizes):
        same = asked.filter(pa.array(sizes == size))
        clusters += clusters_of(same.column("number").to_numpy(), *columns_of(same, size))
    near = found_in_two_walks(rows, clusters, lambda bars: OwnLabel(positives, bars), positives)
    scores: dict[int, list[int]] = {}
    for row in near.select("anchor", "score").distinct().collect():  # `positives` an anchor at most
        scores.setdefault(row.anchor, []).append(row.score)
    far = found_in_two_walks(rows, clusters, lambda bars: OtherLabels(negatives, bars, scores), negatives)
    names = spark.createDataFrame(asked.select(["number", "id"]).rename_columns(["anchor", "anchor_id"]))
    pairs = near.select("anchor", F.col("score").alias("positive_score"), F.col("id").alias("positive_id"))
    return (
        far.select(
            "anchor", F.col("goal").alias("positive_score"), "rank", F.col("id").alias("negative_id"),
            F.col("score").alias("negative_score"),
        )
        .join(pairs, ["anchor", "positive_score"])
        .join(names, "anchor")
        .selectExpr("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )


def query(spark, sf_dir: str) -> DataFrame:
    return mine(table(spark, sf_dir, "embeddings"))


ORACLE_SQL = f"""
WITH rows AS (
  SELECT vec_id AS id, CASE WHEN vec_id % {RELABEL_STEP} = 0 THEN (label + 1) % {LABELS} ELSE label END AS label,
    list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS vector
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: coalesce(isfinite(x), false))) = len(embedding)),
scored AS (
  SELECT a.id AS anchor_id, r.id, a.label = r.label AS same,
    CAST(list_dot_product(a.vector, r.vector) AS BIGINT) AS score
  FROM rows AS a JOIN rows AS r ON a.id <> r.id AND len(a.vector) = len(r.vector)
  WHERE a.id % {ANCHOR_STEP} = 0),
positives AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= {POSITIVES})
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id
    ORDER BY score DESC, id) AS INTEGER) AS rank, id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND {LOW} * positive_score <= 100 * score AND 100 * score <= {HIGH} * positive_score
QUALIFY rank <= {NEGATIVES}
"""
