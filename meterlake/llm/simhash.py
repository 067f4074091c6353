"""SimHash near-dedup with a segment-popcount grid.

A fingerprint is cut into segments, and the number of set bits in each segment makes a point
on a small grid. One differing bit moves the point by one step along one axis, so the
Manhattan distance of two points never exceeds the number of differing bits. Points at most
two steps apart have a grid cell between them that is at most one step from either: every
fingerprint visits its own cell and the cells one step away, pairs meet in a cell, and the
bits are compared exactly. Which of several cells in the middle counts is fixed by a rule, so
that every pair is found once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from meterlake.llm.common import free_names, row_key, stored, text_of
from meterlake.llm.components import components

SHINGLE_WORDS = 3
MAX_BITS = 2
SEED = 42
SEGMENT_BITS = 4
SEGMENTS = 64 // SEGMENT_BITS


def fingerprint_of(text: str, shingle_words: int = SHINGLE_WORDS) -> int:
    """Bits set in over half of the shingle hashes; zero without a word."""
    # On bytes, lower() changes A-Z only and split() knows the six ASCII blanks.
    words = text.encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(word) + 1 for word in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1)).tolist()
    ends = ends.tolist()[shingle_words - 1 :] or [len(joined)]
    digest = xxhash.xxh64_intdigest
    hashes = np.array(
        [digest(joined[a:b], SEED) for a, b in zip(starts, ends, strict=False)], np.uint64
    )
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    over_half = 2 * bits.sum(0, dtype=np.int64) > len(hashes)
    return int(np.packbits(over_half, bitorder="little").view(np.uint64)[0])


def fingerprints(
    docs: DataFrame, shingle_words: int = SHINGLE_WORDS, beside: Column | None = None
) -> DataFrame:
    """`doc_id, beside, bits`: the fingerprint as a signed long, beside a binary column."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint_of(t, shingle_words) for t in batch.column("text").to_pylist()]
            bits = np.array(found, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("beside"), pa.array(bits)],
                ["doc_id", "beside", "bits"],
            )

    more = F.lit(None).cast("binary") if beside is None else beside
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), more.alias("beside"), text_of().alias("text")
    )
    return rows.mapInArrow(hashed, "doc_id long, beside binary, bits long")


def set_bits(segment: int) -> Column:
    part = F.shiftrightunsigned("bits", segment * SEGMENT_BITS)
    return F.bit_count(part.bitwiseAND(F.lit((1 << SEGMENT_BITS) - 1))).cast("int")


def visited_cells(prints: DataFrame) -> DataFrame:
    """`bits, id, cell, step`: step 0 is the own cell, +-(axis + 1) the one beside it."""
    counts = [F.col(f"n{i}") for i in range(SEGMENTS)]
    axis = [F.lit((SEGMENT_BITS + 1) ** i) for i in range(SEGMENTS)]
    own = sum((n.cast("long") * a for n, a in zip(counts, axis, strict=True)), F.lit(0).cast("long"))
    visits = [F.struct(F.col("own").alias("cell"), F.lit(0).alias("step"))]
    for i in range(SEGMENTS):
        up = F.struct((F.col("own") + axis[i]).alias("cell"), F.lit(i + 1).alias("step"))
        down = F.struct((F.col("own") - axis[i]).alias("cell"), F.lit(-i - 1).alias("step"))
        visits += [F.when(counts[i] < SEGMENT_BITS, up), F.when(counts[i] > 0, down)]
    return (
        prints.withColumns({f"n{i}": set_bits(i) for i in range(SEGMENTS)})
        .withColumn("own", own)
        .select("bits", "id", F.explode(F.array_compact(F.array(*visits))).alias("at"))
        .select("bits", "id", "at.cell", "at.step")
    )


def links(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """`a, b`: every pair of different fingerprints at most `max_bits` (0 to 2) apart, once."""
    if max_bits not in (0, 1, 2):
        raise ValueError("the grid finds pairs of at most 2 differing bits")
    visits = visited_cells(prints)
    a, b = visits.alias("a"), visits.alias("b")
    differing = F.bit_count(F.col("a.bits").bitwiseXOR(F.col("b.bits")))
    once = (F.col("a.step") == 0) | (
        (F.col("b.step") != 0)
        & ((F.abs("a.step") < F.abs("b.step")) | (F.col("a.step") == -F.col("b.step")))
    )
    return (
        a.join(b, F.col("a.cell") == F.col("b.cell"))
        .where((F.col("a.bits") < F.col("b.bits")) & once & (differing <= max_bits))
        .select(F.col("a.id").alias("a"), F.col("b.id").alias("b"))
    )


def near_dedup(
    docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS
) -> DataFrame:
    """`doc_id, fingerprint, component_id`, one row per row of `docs`.

    Null and white texts have fingerprint zero and link like any other. Documents with one
    fingerprint are one node of the graph, so copies are never paired with each other. A null
    doc_id gets the component of its fingerprint. Other columns are ignored.
    """
    return grouped(docs, shingle_words, max_bits).drop("beside")


def grouped(
    docs: DataFrame,
    shingle_words: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
    beside: Column | None = None,
) -> DataFrame:
    """As `near_dedup`, with a binary column of the rows beside."""
    # Read three times below; hashing the texts is the costly part.
    hashed = stored(fingerprints(docs, shingle_words, beside), "fingerprints")
    nodes = stored(hashed.groupBy("bits").agg(F.min("doc_id").alias("id")), "nodes")
    known = nodes.where("id IS NOT NULL")
    found = components(links(known, max_bits))
    parts = nodes.join(found, "id", "left").select(
        "bits", F.coalesce("component", "id").alias("component_id")
    )
    return hashed.join(parts, "bits").select(
        "doc_id", "beside", F.lpad(F.lower(F.hex("bits")), 16, "0").alias("fingerprint"),
        "component_id",
    )


def keep_first(docs: DataFrame) -> DataFrame:
    """One document of each group stays: the one with the smallest doc_id, unchanged.

    Rows with one doc_id and different texts are documents of their own; of rows that are equal
    in both, one stays. Null ids come last; documents without an id are grouped with others of
    their own fingerprint. Texts are shuffled once, with a key of their rows.
    """
    rows = grouped(docs, beside=row_key())
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "beside"))
    alone = F.when(F.col("component_id").isNull(), F.col("fingerprint")).alias("alone")
    kept = rows.groupBy("component_id", alone).agg(first.alias("first")).select("first.beside")
    (key,) = free_names(docs, "key")
    keyed = docs.withColumn(key, row_key()).dropDuplicates([key])
    return keyed.join(kept.toDF(key), key, "left_semi").select(*docs.columns)
