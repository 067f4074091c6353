"""Ranked lexical search, every document for every item.

One pass over the documents keeps, of each, its length and how often it has the terms that are
asked for; df, N and L are counts over all of them. Then every task searches its own documents,
a block at a time, with these global counts. Of a block's posting lists for an item, the short
ones are summed term by term into accumulators. These count as one more posting list, with the
largest sum as its bound, beside the long ones. Documents are then taken in order: lists whose
bounds together stay below the item's k-th best score so far open no document and are only
skipped through, for the documents that the other lists name and that can still get in. The
best of each task meet per item.
"""

from __future__ import annotations

import itertools
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from meterlake.llm.common import documents, stored, table, text_of

BEST = 10
# The weights of the score.
LENGTH_SHARE, SCALE, TF_SCALE, LENGTH_SCALE = 90, 1_000_000_000, 1000, 8
# (item, term) pairs that are broadcast at a time; more items are searched in further rounds.
ROUND_TERMS = 200_000
# Documents that a task inverts at a time, and the share of them up to which a list is short.
BLOCK_DOCS = 4096
SHORT_SHARE = 1 / 32
# Stands for a null doc_id in a task; such documents come first among equal scores.
NO_ID = -(1 << 63)
# Bytes of a text that are split at a time.
PART_BYTES = 1 << 20

# Letters and digits of ASCII and all other characters make words; only A-Z is lower-cased.
FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32
    for b in range(256)
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BREAKS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

POSTINGS = "doc_id long, n long, terms array<int>, counts array<long>"


def words_of(text: str) -> Iterator[list[bytes]]:
    """The words of a text in order, in parts that keep a long text small."""
    folded = text.encode().translate(FOLD)
    start = 0
    while len(folded) - start > PART_BYTES:
        end = folded.rfind(b" ", start, start + PART_BYTES)
        if end < 0:  # a word longer than a part
            end = folded.find(b" ", start)
        if end < 0:
            break
        yield folded[start:end].split()
        start = end + 1
    yield folded[start:].split()


@dataclass(frozen=True)
class Asked:
    """The items of a round: their ids, and the numbers of their terms."""

    number_of: dict[bytes, int]
    item_ids: list[int | None]
    terms: list[np.ndarray]

    @classmethod
    def of(cls, rows: pa.Table) -> Asked:
        number_of: dict[bytes, int] = {}
        terms = defaultdict(list)
        for item, term in zip(*(rows.column(c).to_pylist() for c in ("item_id", "term"))):
            terms[item].append(number_of.setdefault(term, len(number_of)))
        return cls(number_of, list(terms), [np.sort(np.array(t)) for t in terms.values()])


def item_terms(items: DataFrame) -> DataFrame:
    """`item_id, term`, each once: rows that share an item_id are one item."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(*(column.to_pylist() for column in batch.columns)):
                terms = sorted(set(itertools.chain.from_iterable(words_of(text))))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([item] * len(terms), pa.int64()), pa.array(terms, pa.binary())],
                    ["item_id", "term"],
                )

    rows = items.select(F.col("item_id").cast("long").alias("item_id"), text_of().alias("text"))
    return rows.mapInArrow(split, "item_id long, term binary").distinct()


def postings(docs: DataFrame, asked: Asked) -> DataFrame:
    """Per document its words with repeats, and the asked terms that it has with their counts."""
    shared = docs.sparkSession.sparkContext.broadcast(asked)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number_of = shared.value.number_of
        for batch in batches:
            sizes, terms, counts = [], [], []
            for text in batch.column("text"):
                size, numbers = 0, []
                for words in words_of(text.as_py()):
                    size += len(words)
                    numbers += [number for number in map(number_of.get, words) if number is not None]
                found, times = np.unique(np.array(numbers, np.int32), return_counts=True)
                sizes.append(size)
                terms.append(found)
                counts.append(times)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), lists_of(terms, pa.int32()),
                 lists_of(counts, pa.int64())],
                ["doc_id", "n", "terms", "counts"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return rows.mapInArrow(counted, POSTINGS)


def lists_of(parts: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    ends = np.cumsum([0, *map(len, parts)])
    values = np.concatenate([*parts, np.empty(0, np.int64)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values).cast(kind))


def weights(index: DataFrame, terms: int, with_terms: int) -> np.ndarray:
    """Weight of every asked term, from its count of documents."""
    df = index.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    ratio = F.lit(2.0 * with_terms + 2) / (2.0 * F.col("df") + 1)
    found = df.select("term", F.floor(1000 * F.log(ratio)).cast("long").alias("weight"))
    weight = np.zeros(terms, np.int64)
    for row in found.toLocalIterator():  # at most a row for each asked term
        weight[row.term] = row.weight
    return weight


class Searcher:
    """The best documents of every item among those that one task has seen."""

    def __init__(self, asked: Asked, weight: np.ndarray, k: int):
        self.asked, self.weight, self.k = asked, weight, k
        nothing = np.empty(0, np.int64)
        self.best = [(nothing, nothing) for _ in asked.terms]

    def add(self, block: pa.RecordBatch) -> None:
        """A block of documents with their postings."""
        ids, m = (block.column(c).fill_null(NO_ID).to_numpy(zero_copy_only=False) for c in ("doc_id", "m"))
        terms, counts = (block.column(c).flatten().to_numpy() for c in ("terms", "counts"))
        if not len(terms):
            return
        docs = np.repeat(np.arange(len(ids)), block.column("terms").value_lengths().to_numpy())
        parts = self.weight[terms] * ((SCALE * counts) // (TF_SCALE * counts + LENGTH_SCALE * m[docs]))
        order = np.argsort(terms, kind="stable")
        docs, parts = docs[order], parts[order]
        there, firsts = np.unique(terms[order], return_index=True)
        lists = np.zeros((2, len(self.weight)), np.int64)
        lists[:, there] = firsts, np.append(firsts[1:], len(terms))
        bounds = np.zeros(len(self.weight), np.int64)
        bounds[there] = np.maximum.reduceat(parts, firsts)
        short = max(1, int(SHORT_SHARE * len(ids)))
        for item, asked in enumerate(self.asked.terms):
            bar = self.bar(item)
            if bounds[asked].sum() < bar:
                continue
            asked = asked[bounds[asked] > 0]
            spans = [(slice(a, b), bound) for a, b, bound in zip(*lists[:, asked], bounds[asked])]
            few = [span for span, _ in spans if span.stop - span.start <= short]
            iterators = [
                (docs[span], parts[span], bound) for span, bound in spans if span.stop - span.start > short
            ]
            if few:
                iterators.append(accumulators(docs, parts, few))
            found, scores = self.walk(iterators, len(ids), bar)
            if len(found):
                self.keep(item, ids[found], scores)

    def bar(self, item: int) -> int:
        """What a score must reach; zero never counts."""
        scores = self.best[item][1]
        return max(1, int(scores[-1])) if len(scores) == self.k else 1

    def walk(self, iterators: list, size: int, bar: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents with at least `bar`, and their scores.

        Lists in the order of their bounds; those before the first whose running sum of bounds
        reaches the bar cannot lift a document over it by themselves.
        """
        iterators.sort(key=lambda one: one[2])
        reach = np.cumsum([bound for *_, bound in iterators])
        opens = int(np.searchsorted(reach, bar))
        if opens == len(iterators):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        scores, met = np.zeros(size, np.int64), np.zeros(size, bool)
        for docs, parts, _ in iterators[opens:]:
            scores[docs] += parts
            met[docs] = True
        found = np.flatnonzero(met)
        for at in range(opens - 1, -1, -1):
            found = found[scores[found] + reach[at] >= bar]
            if not len(found):
                break
            docs, parts, _ = iterators[at]
            places = np.minimum(np.searchsorted(docs, found), len(docs) - 1)
            hit = docs[places] == found
            scores[found[hit]] += parts[places[hit]]
        found = found[scores[found] >= bar]
        return found, scores[found]

    def keep(self, item: int, ids: np.ndarray, scores: np.ndarray) -> None:
        ids, scores = (np.concatenate(pair) for pair in zip(self.best[item], (ids, scores)))
        first = np.lexsort((ids, -scores))[: self.k]
        self.best[item] = ids[first], scores[first]


def accumulators(docs: np.ndarray, parts: np.ndarray, lists: list[slice]) -> tuple:
    """The lists added up term by term, as one list in the order of documents."""
    met = np.concatenate([docs[span] for span in lists])
    there, place = np.unique(met, return_inverse=True)
    sums = np.zeros(len(there), np.int64)
    np.add.at(sums, place, np.concatenate([parts[span] for span in lists]))
    return there, sums, int(sums.max())


def best_of_tasks(index: DataFrame, asked: Asked, weight: np.ndarray, k: int) -> DataFrame:
    """`item_id, doc_id, score`: up to `k` documents of every item from each task."""
    shared = index.sparkSession.sparkContext.broadcast((asked, weight))

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, weight = shared.value
        searcher = Searcher(asked, weight, k)
        for batch in batches:
            for start in range(0, len(batch), BLOCK_DOCS):
                searcher.add(batch.slice(start, BLOCK_DOCS))
        items = [[item] * len(ids) for item, (ids, _) in zip(asked.item_ids, searcher.best)]
        ids, scores = (np.concatenate(part) for part in zip(*searcher.best))
        yield pa.RecordBatch.from_arrays(
            [pa.array(itertools.chain(*items), pa.int64()), pa.array(ids, mask=ids == NO_ID),
             pa.array(scores)],
            ["item_id", "doc_id", "score"],
        )

    return index.mapInArrow(searched, "item_id long, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, k: int = BEST, round_terms: int = ROUND_TERMS) -> DataFrame:
    """`item_id, rank, doc_id, score`: the `k` best documents with a score above 0 per item.

    `items` has `item_id, text`, `docs` has `doc_id, text`; other columns are ignored, whatever
    their names. Null texts count as empty: such an item has no rows, such a document counts
    nowhere. Equal scores go to the smaller doc_id, null ones first. Every row of `docs` is a
    document of its own, also if it repeats another; rows of `items` that share an item_id,
    null included, are one item. Without documents or items there are no rows. Items are
    searched in rounds of about `round_terms` terms, each over all documents.
    """
    spark = docs.sparkSession
    asked = stored(item_terms(items), "asked")
    rounds = -(-asked.count() // round_terms)
    found = spark.createDataFrame([], "item_id long, doc_id long, score long")
    for number in range(rounds):
        part = F.pmod(F.xxhash64("item_id"), F.lit(rounds)) == number
        terms = Asked.of(asked.where(part).toArrow())
        if terms.item_ids:
            found = found.unionByName(search_round(docs, terms, k))
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), "doc_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("item_id", "rank", "doc_id", "score")
    )


def search_round(docs: DataFrame, asked: Asked, k: int) -> DataFrame:
    index = stored(postings(docs, asked), "postings")
    total, with_terms = index.agg(F.sum("n"), F.count_if(F.col("n") > 0)).first()
    if not total:
        return docs.sparkSession.createDataFrame([], "item_id long, doc_id long, score long")
    weight = weights(index, len(asked.number_of), with_terms)
    # Decimal: the product may be too large for 64 bits.
    share = f"CAST({LENGTH_SHARE} * CAST(n AS DECIMAL(18, 0)) * {with_terms}BD div {total} AS BIGINT)"
    met = index.where(F.size("terms") > 0).select(
        "doc_id", F.expr(f"100 - {LENGTH_SHARE} + {share}").alias("m"), "terms", "counts"
    )
    return best_of_tasks(met, asked, weight, k)


def query(spark, sf_dir: str) -> DataFrame:
    return search(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


ORACLE_SQL = rf"""
WITH words AS (
  SELECT row, doc_id, unnest(list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{BREAKS}'), lambda x: x <> '')) AS term
  FROM (SELECT *, row_number() OVER () AS row FROM documents)),
asked AS (
  SELECT DISTINCT item_id, unnest(list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{BREAKS}'), lambda x: x <> '')) AS term
  FROM benchmark),
lengths AS (SELECT row, count(*) AS n FROM words GROUP BY row),
corpus AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM lengths),
tf AS (
  SELECT row, doc_id, term, count(*) AS tf FROM words
  WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM tf, corpus GROUP BY term, docs),
scores AS (
  SELECT a.item_id, t.row, t.doc_id,
    CAST(sum(w * (({SCALE} * tf) // ({TF_SCALE} * tf
      + {LENGTH_SCALE} * (100 - {LENGTH_SHARE} + ({LENGTH_SHARE} * n * docs) // total)))) AS BIGINT) AS score
  FROM asked AS a JOIN tf AS t USING (term) JOIN weights USING (term) JOIN lengths USING (row), corpus
  GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER)
    AS rank, doc_id, score
FROM scores WHERE score > 0
QUALIFY rank <= {BEST}
"""
