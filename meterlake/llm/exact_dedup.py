"""Exact dedup by two passes over a Bloom filter.

Pass one hashes every text to a few bits of a blocked Bloom filter and keeps the bits that
were set at least twice. Pass two tests every row against that filter, which is broadcast and
never larger than `MAX_BITS`. A row with a bit set only once is certainly unique and passes
straight through, without a shuffle. The rest, the possible repeats, are compared by SHA-256.
A filter too small for its table lets more rows through to the exact comparison; it cannot
lose one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from meterlake.llm.common import stored, text_of

# Bits in one block, as `bitmap_construct_agg` makes them: one row of 4 kB.
BLOCK_BITS = 32768
BITS_PER_ROW = 16
# 32 MB: the bound of what is broadcast.
MAX_BITS = 1 << 28


def exact_dedup(docs: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """One row per document: `doc_id, keep_id, group_size, kept, text_sha256`.

    Texts are equal when identical; null counts as empty. The largest doc_id of a group stays.
    Rows repeating a doc_id and text count in `group_size` and are all kept. Other columns
    are ignored; an empty table gives no rows.
    """
    rows = docs.select("doc_id", text_of().alias("text"))
    blocks = block_count(rows.count(), max_bits)
    # Bound: blocks <= max_bits / BLOCK_BITS rows of 4 kB each.
    repeated = F.broadcast(repeated_bits(rows, blocks))
    tested = (
        rows.withColumn("hash", F.xxhash64("text"))
        .withColumn("block", block(blocks))
        .join(repeated, "block", "left")
        .withColumn("maybe", F.coalesce(bit_is_set(0) & bit_is_set(1), F.lit(False)))
        .select("doc_id", "maybe", F.sha2("text", 256).alias("text_sha256"))
    )
    unique = tested.where(~F.col("maybe")).select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), "text_sha256",
    )
    return unique.union(grouped(tested.where("maybe").drop("maybe")))


def block_count(rows: int, max_bits: int = MAX_BITS) -> int:
    wanted = min(rows * BITS_PER_ROW, max_bits)
    return max(1, -(-wanted // BLOCK_BITS))


def block(blocks: int) -> Column:
    return F.pmod("hash", F.lit(blocks)).cast("int")


def bit(k: int) -> Column:
    """Position of the row's k-th bit in its block, from the upper bits of the hash."""
    shifted = F.shiftrightunsigned("hash", 49 - 15 * k)
    return shifted.bitwiseAND(F.lit(BLOCK_BITS - 1)).cast("int")


def bit_is_set(k: int) -> Column:
    byte = F.substring(F.col("bits"), (bit(k) / 8).cast("int") + 1, F.lit(1))
    value = F.conv(F.hex(byte), 16, 10).cast("int")
    power = F.pow(F.lit(2), bit(k) % 8).cast("int")
    return value.bitwiseAND(power) != 0


def repeated_bits(rows: DataFrame, blocks: int) -> DataFrame:
    """`block, bits`: the bits that at least two rows set.

    Bits are counted within each task first, so a text that a third of the rows share sends
    one count per task. Only bits seen twice are brought together by block.
    """
    seen = (
        rows.select(F.xxhash64("text").alias("hash"))
        .select(block(blocks).alias("block"), F.explode(F.array(bit(0), bit(1))).alias("bit"))
        .groupBy("block", "bit")
        .count()
        .where("count > 1")
    )
    return (
        seen.repartition("block")
        .groupBy("block")
        .agg(F.bitmap_construct_agg(F.col("bit").cast("long")).alias("bits"))
    )


def grouped(rows: DataFrame) -> DataFrame:
    """Exact groups of the possible repeats. Counts combine before the shuffle. The groups are
    stored, so that both sides of the join back are shuffled for it and adaptive execution can
    split a hot text."""
    groups = stored(
        rows.groupBy("text_sha256").agg(
            F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")
        ),
        "groups",
    )
    return rows.join(groups, "text_sha256").select(
        "doc_id", "keep_id", "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256",
    )


ORACLE_SQL = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
  doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW g AS (PARTITION BY coalesce(text, ''))
"""
