"""Quality classifier by Bradley-Terry ranking.

Each document has a strength, a weighted sum of features of its text. A pair of a good and a
bad document is a comparison that the good one won; the weights minimise the logistic loss on
the difference of the two feature vectors. Weights come from a sample. All labelled rows
outside the held-out fold say which share of each label lies below a strength, and so which
quantile parts the labels best; that quantile of the strengths of all documents becomes the
cut, and the score is shifted so that the cut scores `CUT_SCORE`.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from meterlake.llm.common import documents, table, text_of

# Bound of the labelled rows that train the model, for each label.
SAMPLE_PER_LABEL = 4000
PAIRS_PER_DOCUMENT = 8
CUT_SCORE = 0.3
# Steps of strength in which documents are counted for the quantile; STEPS bounds what reaches
# the driver, two rows for each of them.
STEP = 0.002
STEPS = 50_000
HELD_OUT_FOLDS = 5

FEATURES = (
    "symbols", "exclamations", "bars", "upper", "digits", "stops", "blanks", "accented",
    "word_length", "long_words", "distinct_words", "same_as_previous", "repeated_lines",
    "ending_in_symbol", "log_words",
)

_CLASSES = np.full(256, 8, np.uint8)
for _number, _bytes in enumerate(
    (b"#$%&*@^~<>{}[]=\\", b"!?", b"|", bytes(range(65, 91)), b"0123456789", b".,;:", b" \t\n\r")
):
    _CLASSES[list(_bytes)] = _number
_CLASSES[128:] = 7


@dataclass(frozen=True)
class Ranking:
    """Centre and spread of the features, their weights, the cut in strength."""

    centre: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    cut: float

    def strengths(self, features: np.ndarray) -> np.ndarray:
        return (features - self.centre) / self.spread @ self.weights

    def scores(self, features: np.ndarray) -> np.ndarray:
        strength = self.strengths(features)
        shift = np.log(CUT_SCORE / (1 - CUT_SCORE))
        return 1 / (1 + np.exp(-np.clip(strength - self.cut + shift, -30, 30)))


def held_out() -> Column:
    fold = F.crc32(F.col("doc_id").cast("string")) % HELD_OUT_FOLDS
    return F.coalesce(fold == 0, F.lit(False))


def text_features(text: str) -> list[float]:
    raw = text.encode()
    counts = np.bincount(_CLASSES[np.frombuffer(raw, np.uint8)], minlength=9)
    words = text.split()
    n_bytes, n_words = max(1, len(raw)), max(1, len(words))
    shares = counts[:8] / n_bytes
    lines = [line for line in text.split("\n") if line.strip()]
    same = sum(map(str.__eq__, words[1:], words[:-1]))
    return [
        *np.log1p(50 * shares),
        np.log1p(n_bytes / n_words),
        sum(len(word) > 15 for word in words) / n_words,
        # Type-token ratio against what a text of this length would have.
        len(set(words)) / n_words**0.9,
        np.log1p(20 * same / n_words),
        1 - len(set(lines)) / max(1, len(lines)),
        sum(word[-1] in "#$%&*!" for word in words) / n_words,
        np.log1p(len(words)),
    ]


def feature_matrix(texts) -> np.ndarray:
    rows = [text_features(text) for text in texts]
    return np.array(rows, float).reshape(len(rows), len(FEATURES))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE_PER_LABEL) -> Ranking | None:
    """Learn from labelled rows outside the held-out fold; None without both labels.

    At most `sample` rows of each label, those with the smallest hash of their doc_id, come
    to the driver, as feature vectors. The cut comes from all rows of `docs`.
    """
    known = labels.where(~held_out() & F.col("quality").isin(0, 1)).select("doc_id", "quality")
    chosen = None
    for label in (0, 1):
        part = known.where(F.col("quality") == label).orderBy(F.xxhash64("doc_id"), "doc_id")
        chosen = part.limit(sample) if chosen is None else chosen.union(part.limit(sample))
    # Bound: 2 * sample rows of two numbers.
    rows = docs.select("doc_id", text_of().alias("text")).join(F.broadcast(chosen), "doc_id")
    schema = "doc_id long, quality int, features array<double>"

    def vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = list(feature_matrix(batch["text"]))
            yield batch[["doc_id", "quality"]].assign(features=found)

    # A doc_id that many rows repeat does not loosen the bound.
    once = rows.dropDuplicates(["doc_id"])
    learned = once.mapInPandas(vectors, schema).toPandas().sort_values("doc_id")
    good = learned["quality"].to_numpy() == 1
    if good.all() or not good.any():
        return None
    ranking = rank(np.stack(learned["features"]), good)
    return replace(ranking, cut=cut_of(*counts_of(docs, known, ranking)))


def rank(features: np.ndarray, good: np.ndarray) -> Ranking:
    """The weights; the cut is still open."""
    centre, spread = features.mean(0), features.std(0) + 1e-6
    scaled = (features - centre) / spread
    draw = np.random.default_rng(0)
    winners, losers = np.flatnonzero(good), np.flatnonzero(~good)
    pairs = PAIRS_PER_DOCUMENT * len(good)
    won = scaled[winners[draw.integers(len(winners), size=pairs)]]
    difference = won - scaled[losers[draw.integers(len(losers), size=pairs)]]
    weights = np.zeros(features.shape[1])
    for _ in range(30):
        lost = 1 / (1 + np.exp(np.clip(difference @ weights, -30, 30)))
        gradient = -(difference * lost[:, None]).mean(0) + 1e-3 * weights
        curve = difference * (lost * (1 - lost))[:, None]
        hessian = difference.T @ curve / pairs + 1e-3 * np.eye(len(weights))
        weights -= np.linalg.solve(hessian, gradient)
    return Ranking(centre, spread, weights, 0.0)


def counts_of(docs: DataFrame, known: DataFrame, ranking: Ranking) -> tuple[np.ndarray, ...]:
    """Steps of strength in order, and in each the bad and good training rows and all documents."""

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            strength = ranking.strengths(feature_matrix(batch.column("text").to_pylist()))
            step = np.clip(np.floor(strength / STEP), -STEPS, STEPS - 1).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(step)], ["doc_id", "step"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    steps = rows.mapInArrow(placed, "doc_id long, step long")
    label = known.groupBy("doc_id").agg(
        F.sum((F.col("quality") == 0).cast("long")).alias("bad"),
        F.sum((F.col("quality") == 1).cast("long")).alias("good"),
    )
    found = (
        steps.join(label, "doc_id", "left")
        .groupBy("step")
        .agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"), F.count("*").alias("n"))
        .toPandas()
        .fillna(0)
        .sort_values("step")
    )
    return tuple(found[name].to_numpy() for name in ("step", "bad", "good", "n"))


def cut_of(step: np.ndarray, bad: np.ndarray, good: np.ndarray, documents: np.ndarray) -> float:
    """The quantile of the documents' strength that parts the labels best.

    Both labels count alike; of equally good quantiles the middle one is taken.
    """
    quantile = np.cumsum(documents) / documents.sum()
    gain = np.cumsum(bad) / max(1, bad.sum()) - np.cumsum(good) / max(1, good.sum())
    best = quantile[gain >= gain.max() - 1e-12]
    at = int(np.searchsorted(quantile, (best[0] + best[-1]) / 2))
    return float(step[at] + 1) * STEP


def score_documents(docs: DataFrame, ranking: Ranking | None) -> DataFrame:
    """`doc_id, score`; 0.5 for all without a ranking."""

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            scores = (
                np.full(len(texts), 0.5) if ranking is None else ranking.scores(feature_matrix(texts))
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(scores)], ["doc_id", "score"]
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return rows.mapInArrow(scored, "doc_id long, score double")


def classify(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE_PER_LABEL) -> DataFrame:
    """`doc_id, held_out, score, predicted`, one row per row of `docs`.

    Only texts enter a score; null counts as empty, and empty texts are scored like others.
    Without training rows of both labels every score is 0.5. A null doc_id is not held out.
    Rows that repeat a doc_id are scored by their own text. Columns besides doc_id and text
    are ignored.
    """
    return score_documents(docs, fit(docs, labels, sample)).select(
        "doc_id", held_out().alias("held_out"), "score",
        F.when(F.col("score") >= CUT_SCORE, 1).otherwise(0).alias("predicted"),
    )


def query(spark, sf_dir: str) -> DataFrame:
    return classify(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of `docs` that are not rejected, unchanged: scored in place, without a join."""
    ranking = fit(docs, labels)
    columns = docs.columns

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if ranking is None:
                yield batch
                continue
            texts = [text or "" for text in batch.column(columns.index("text")).to_pylist()]
            yield batch.filter(pa.array(ranking.scores(feature_matrix(texts)) >= CUT_SCORE))

    return docs.mapInArrow(kept, docs.schema)
