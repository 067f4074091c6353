"""Hierarchical best-fit packing of token sequences.

Every partition packs its pieces by best fit, largest first, and emits the bins that are
nearly full. Bins that are not become items themselves: groups of partitions merge, best fit
runs again on the leftovers of the group, and so on up a tree. A task never holds more than
about `ITEMS_PER_TASK` items, so the top of the tree is as wide as the leftovers need.
"""

from __future__ import annotations

import base64
import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from meterlake.llm.common import stored, text_of

MAX_TOKENS = 2048
END_ID = 0
# A bin with at most so many free places is not offered again.
NEARLY_FULL = 4
FAN_IN = 8
ITEMS_PER_TASK = 100_000

MEMBER = "struct<doc_id: bigint, piece: int, start: bigint, length: bigint, ids_crc32: bigint>"
BIN = f"used long, members array<{MEMBER}>"
MEMBER_TYPE = pa.struct(
    [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
     ("length", pa.int64()), ("ids_crc32", pa.int64())]
)


def public_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def load_encoding(path: str | None = None, tokenizer: str | None = None):
    """Byte-level BPE of 50,257 ids, read from its ranks file, with the added tokens of the
    tokenizer's JSON, whose strings in a text are one id each, as in `tokenizers`."""
    import public_tokenizers
    import tiktoken

    with open(path or public_path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    with open(tokenizer or public_path("byte_bpe_50k.json"), encoding="utf-8") as described:
        added = {token["content"]: token["id"] for token in json.load(described)["added_tokens"]}
    return tiktoken.Encoding(
        "byte_bpe_50k", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=added
    )


def cut(length: int, max_tokens: int = MAX_TOKENS) -> list[tuple[int, int]]:
    """(start, length) of the pieces: whole sequences, the first may be shorter."""
    first = length % max_tokens or min(length, max_tokens)
    starts = [0, *range(first, length, max_tokens)]
    return list(zip(starts, np.diff([*starts, length]).tolist(), strict=True))


def pieces(docs: DataFrame, tokenizer: str | None = None, max_tokens: int = MAX_TOKENS) -> DataFrame:
    """`doc_id, piece, start, length, ids_crc32` for every row; null text counts as empty."""

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = load_encoding(tokenizer)
        for batch in batches:
            rows = []
            for doc_id, text in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                ids = np.append(encoding.encode_to_numpy(text, allowed_special="all"), END_ID)
                raw = ids.astype("<u4").tobytes()
                for number, (start, length) in enumerate(cut(len(ids), max_tokens)):
                    part = raw[4 * start : 4 * (start + length)]
                    rows.append((doc_id, number, start, length, zlib.crc32(part)))
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, MEMBER_TYPE, strict=True)],
                [f.name for f in MEMBER_TYPE],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return rows.mapInArrow(
        cut_up, "doc_id long, piece int, start long, length long, ids_crc32 long"
    )


def best_fit(sizes: list[int], room: int) -> list[list[int]]:
    """Bins of item numbers: largest first, each into the fullest bin that still takes it."""
    bins: list[list[int]] = []
    with_room: list[list[int]] = [[] for _ in range(room + 1)]
    filled = 0  # bit r is set if a bin has exactly r free places
    for item in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        fits = filled >> sizes[item]
        if fits:
            free = (fits & -fits).bit_length() - 1 + sizes[item]
            target = with_room[free].pop()
            if not with_room[free]:
                filled &= ~(1 << free)
        else:
            free, target = room, len(bins)
            bins.append([])
        bins[target].append(item)
        free -= sizes[item]
        if free:
            with_room[free].append(target)
            filled |= 1 << free
    return bins


def pack_round(items: DataFrame, level: int, max_tokens: int, nearly_full: int) -> DataFrame:
    """One best-fit round inside each partition: `sequence_id, used, members, open`."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(list(batches)) if (batches := list(batches)) else None
        if rows is None:
            return
        members = rows.column("members").to_pylist()
        found = best_fit(rows.column("used").to_pylist(), max_tokens)
        first = (level << 48) + (TaskContext.get().partitionId() << 24)
        for at in range(0, len(found), 10_000):
            block = found[at : at + 10_000]
            joined = [[m for item in group for m in members[item]] for group in block]
            used = [sum(m["length"] for m in group) for group in joined]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(range(first + at, first + at + len(block)), pa.int64()),
                    pa.array(used, pa.int64()),
                    pa.array(joined, pa.list_(MEMBER_TYPE)),
                    pa.array([max_tokens - n > nearly_full for n in used]),
                ],
                ["sequence_id", "used", "members", "open"],
            )

    return items.mapInArrow(packed, f"sequence_id long, {BIN}, open boolean")


def pack(
    docs: DataFrame,
    tokenizer: str | None = None,
    max_tokens: int = MAX_TOKENS,
    nearly_full: int = NEARLY_FULL,
    items_per_task: int = ITEMS_PER_TASK,
) -> DataFrame:
    """Place every document: `doc_id, piece, start, length, ids_crc32, sequence_id, offset`.

    A document's ids are followed by id 0; one longer than a sequence is cut, the first piece
    may be shorter. Null text counts as empty and takes one place. Rows that repeat a doc_id
    are placed each. Other columns are ignored; an empty table gives no rows.
    """
    cut_up = stored(pieces(docs, tokenizer, max_tokens), "pieces")
    whole = (
        cut_up.where(F.col("length") == max_tokens)
        .withColumn("sequence_id", -1 - F.monotonically_increasing_id())
        .withColumn("offset", F.lit(0).cast("long"))
    )
    items = cut_up.where(F.col("length") < max_tokens).select(
        F.col("length").alias("used"), F.array(F.struct(*cut_up.columns)).alias("members")
    )
    waiting = items.count()
    width = max(1, -(-waiting // items_per_task))
    done, level = [], 0
    while True:
        packed = stored(
            pack_round(items.repartition(width), level, max_tokens, nearly_full), "bins"
        )
        left = packed.where("open").count()
        narrower = max(-(-width // FAN_IN), -(-left // items_per_task))
        if width == 1 or left == 0 or (level and left > 0.999 * waiting):
            done.append(packed)
            break
        done.append(packed.where("NOT open"))
        items = packed.where("open").select("used", "members")
        waiting, width, level = left, max(1, narrower), level + 1
    bins = done[0]
    for part in done[1:]:
        bins = bins.union(part)
    return whole.union(placed(bins).select(*whole.columns))


def placed(bins: DataFrame) -> DataFrame:
    """One row per member, with its place: the lengths before it in its sequence."""
    before = F.transform(
        "members",
        lambda m, i: F.struct(
            m.alias("m"),
            F.aggregate(
                F.slice("members", 1, i), F.lit(0).cast("long"), lambda total, x: total + x["length"]
            ).alias("offset"),
        ),
    )
    return bins.select("sequence_id", F.explode(before).alias("at")).select(
        "at.m.*", "sequence_id", "at.offset"
    )
