"""Removal of long repeated byte strings, by the common-prefix intervals of suffix arrays.

A suffix array of all bytes is too large to shuffle, so only suffixes that can start a repeat
of `LENGTH` bytes are kept, in buckets that hold every suffix they can share a prefix with:

1. Anchors: in every window of `LENGTH` bytes the `GRAM`-byte string with the smallest hash.
   Equal windows have equal anchors, so a repeat shows as a repeated anchor string.
2. The repeated anchor strings go into a Bloom filter of bounded size. A second reading of the
   documents emits the anchors that pass, with a hash of what stands around them, their
   context; where one anchor string has several contexts, also with its bytes.
3. All anchors with one string meet (hot ones by the string and what stands on one side). Places with an equal context are one leaf. For anchor
   strings with several contexts the windows are put in order of content, which makes
   enhanced suffix arrays, each of whole buckets: buckets of suffixes that agree in their first `LENGTH` bytes, sorted
   by what follows, with the lengths of their common prefixes. A bucket whose members are all
   preceded by the same byte is only the tail of another one and is passed over; the others
   are scanned with a stack. Every interval is a group of places with a common string; all
   places but the first are repeats over the full depth of the interval.

A repeat longer than a context is a chain of groups, one for each anchor in it.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, functions as F

from meterlake.llm.common import text_of

LENGTH = 100
GRAM = 24
# Grams in a window.
SPAN = LENGTH - GRAM + 1
# Context of an anchor: every window around it, and the byte before the first.
LEFT = SPAN
CONTEXT = LEFT + LENGTH
# What a context has at most behind a window.
TAIL = CONTEXT - LENGTH - 1
# Shared by equal windows on the one side of an anchor or the other.
SHARED_LEFT = (LENGTH - GRAM) // 2
SHARED_RIGHT = LENGTH - SHARED_LEFT
# 32 MB for each of three filters: the bound of what is broadcast.
MAX_FILTER_BITS = 1 << 28
BITS_PER_GRAM = 32
BLOCK_BITS = 32768
# Parts in which the filters come to the driver.
FILTER_PARTS = 8
# Texts are hashed in parts of so many bytes.
PART_BYTES = 1 << 18
# Contexts worked on at a time in a task; an anchor string is not divided among them.
CONTEXTS_AT_ONCE = 4000
ROWS_AT_ONCE = 4000
# Equal windows sorted at a time in a task; those of one content are not divided.
WINDOWS_AT_ONCE = 50_000
# An anchor string with more places than this is hot: see `split_keys`.
HOT_PLACES = 500

_FACTOR = 0x9E3779B97F4A7C15


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits in which every bit depends on every other."""
    values = (values ^ (values >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    values = (values ^ (values >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return values ^ (values >> np.uint64(32))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_FACTOR))


@functools.lru_cache(maxsize=16)
def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the factor, and of its inverse, modulo 2**64."""

    def series(base: int) -> np.ndarray:
        steps = np.full(size, base, np.uint64)
        steps[0] = 1
        return np.multiply.accumulate(steps)

    return series(_FACTOR), series(pow(_FACTOR, -1, 1 << 64))


def powers_for(length: int) -> tuple[np.ndarray, np.ndarray]:
    return powers(1 << max(12, (length + 1).bit_length()))


class Hashes:
    """Hashes of any stretch of one text (or of each row of equally long texts)."""

    def __init__(self, raw: np.ndarray):
        self.up, down = powers_for(raw.shape[-1])
        terms = _BYTE[raw] * down[: raw.shape[-1]]
        start = np.zeros((*raw.shape[:-1], 1), np.uint64)
        self.sums = np.concatenate([start, np.cumsum(terms, axis=-1, dtype=np.uint64)], axis=-1)

    def of(self, start: np.ndarray, end: np.ndarray, row=None) -> np.ndarray:
        at = (lambda i: i) if row is None else (lambda i: (row, i))
        return mix((self.sums[at(end)] - self.sums[at(start)]) * self.up[start])

    def grams(self) -> np.ndarray:
        size = max(0, self.sums.shape[-1] - GRAM)
        return mix((self.sums[..., GRAM:] - self.sums[..., :size]) * self.up[:size])


def running(values: np.ndarray, width: int, best) -> np.ndarray:
    """Best of every `width` neighbours, by doubling."""
    reach = 1
    while 2 * reach <= width:
        values = best(values[:-reach], values[reach:])
        reach *= 2
    rest = width - reach
    return best(values[: len(values) - rest], values[rest:]) if rest else values


def anchors(grams: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """Places whose gram is the smallest of some `whole` window; all if several are equal."""
    if len(grams) < SPAN:
        return np.empty(0, np.int64)
    smallest = running(grams, SPAN, np.minimum)
    smallest = np.where(whole[: len(smallest)], smallest, np.uint64(0))
    edge = np.zeros(SPAN - 1, np.uint64)
    largest = running(np.concatenate([edge, smallest, edge]), SPAN, np.maximum)
    return np.flatnonzero(largest == grams)


def anchor_table(raw: np.ndarray, starts: np.ndarray):
    """Text, place, gram hash, context hash, and lengths to the left and right of every anchor.

    `raw` holds texts one after the other, `starts` where they begin; no window, gram or
    context crosses a border.
    """
    hashes = Hashes(raw)
    grams = hashes.grams()
    sizes = np.diff([*starts, len(raw)])
    at = anchors(grams, ends_of_windows(starts, sizes))
    text = np.searchsorted(starts, at, side="right") - 1
    place = at - starts[text]
    left, right = np.minimum(place, LEFT), np.minimum(sizes[text] - place, LENGTH)
    around = hashes.of(at - left, at + right)
    context = mix(around + (left * 256 + right).astype(np.uint64))
    return text, place, grams[at], context, left, right


def ends_of_windows(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """For every byte, whether a window that starts there ends in the same text."""
    last = np.repeat(starts + sizes, sizes)
    return np.arange(len(last)) + LENGTH <= last


def parts_of(raw: bytes) -> Iterator[tuple[int, int, int]]:
    """Parts of a long text: where its own anchors begin and end, and the margin before."""
    for start in range(0, max(1, len(raw)), PART_BYTES):
        yield start, min(start + PART_BYTES, len(raw)), min(start, 2 * CONTEXT)


def anchors_of(texts: list[bytes | memoryview]) -> Iterator[tuple[np.ndarray, ...]]:
    """The columns of `anchor_table`, for about `PART_BYTES` at a time.

    Longer texts are read in parts that overlap enough for every window and context.
    """
    pending, numbers, size = [], [], 0
    for number, raw in enumerate(texts):
        if len(raw) <= PART_BYTES:
            pending.append(raw)
            numbers.append(number)
            size += len(raw)
        else:
            for start, end, margin in parts_of(raw):
                low = start - margin
                found = table_of([raw[low : end + 2 * CONTEXT]])
                place = found[1] + low
                own = (place >= start) & (place < end)
                yield np.full(own.sum(), number), place[own], *(c[own] for c in found[2:])
        if size >= PART_BYTES or number == len(texts) - 1:
            if pending:
                text, *rest = table_of(pending)
                yield np.array(numbers)[text], *rest
            pending, numbers, size = [], [], 0


def table_of(texts: list[bytes | memoryview]):
    sizes = np.array([len(raw) for raw in texts])
    return anchor_table(np.frombuffer(b"".join(texts), np.uint8), np.cumsum(sizes) - sizes)


def encoded(column: pa.Array) -> list[memoryview]:
    """The texts in UTF-8, where they stand in the column."""
    column = column.cast(pa.binary())
    if not len(column):
        return []
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1].tolist()
    raw = memoryview(data or b"")
    return [raw[a:b] for a, b in itertools.pairwise(ends)]


# --- the two readings of the documents


def repeated_grams(rows: DataFrame) -> DataFrame:
    """`gram, places, diverse` of the anchor strings that stand at two places or more. They are
    counted in each task before they meet."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, grams, contexts, _, _ in anchors_of(encoded(batch.column("text"))):
                columns = [pa.array(c.view(np.int64)) for c in (grams, contexts)]
                yield pa.RecordBatch.from_arrays(columns, ["gram", "context"])

    places = rows.select("text").mapInArrow(read, "gram long, context long")
    return (
        places.groupBy("gram")
        .agg(
            F.count("*").alias("places"),
            (F.min("context") != F.max("context")).alias("diverse"),
        )
        .where("places > 1")
    )


def bloom_filters(grams: DataFrame, bits: int, *kinds: str) -> list[np.ndarray]:
    """For each boolean column, one bit per gram where it is true, `bits` in all: at most
    `MAX_FILTER_BITS` a filter come to the driver."""
    at = F.pmod("gram", F.lit(bits))
    blocks = (
        grams.select(
            (at / BLOCK_BITS).cast("int").alias("block"),
            *(F.when(F.col(kind), at % BLOCK_BITS).alias(kind) for kind in kinds),
        )
        # Grams are moved, not a bitmap of each task; all filters come with one run.
        .repartition("block")
        .groupBy("block")
        .agg(*(F.bitmap_construct_agg(kind).alias(kind) for kind in kinds))
        .repartition(FILTER_PARTS)
    )
    found = [np.zeros(bits // 8, np.uint8) for _ in kinds]
    for row in blocks.toLocalIterator():
        start = row["block"] * BLOCK_BITS // 8
        for kind, into in zip(kinds, found, strict=True):
            into[start : start + BLOCK_BITS // 8] = np.frombuffer(row[kind], np.uint8)
    return found


def gram_filters(rows: DataFrame, **kinds: Column) -> list[np.ndarray]:
    """For each condition on `repeated_grams`, a filter that holds the strings that meet it.

    The strings stay on the executors' disks, and only until the filters are made.
    """
    columns = [condition.alias(kind) for kind, condition in kinds.items()]
    grams = repeated_grams(rows).select("gram", *columns).persist(StorageLevel.DISK_ONLY)
    try:
        wanted = grams.count() * BITS_PER_GRAM
        bits = min(MAX_FILTER_BITS, BLOCK_BITS * (1 + wanted // BLOCK_BITS))
        return bloom_filters(grams, bits, *kinds)
    finally:
        grams.unpersist()


def passes(found: np.ndarray, grams: np.ndarray) -> np.ndarray:
    at = grams.view(np.int64) % (8 * len(found))
    return (found[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


PLACE = "gram long, context long, doc_id long, at int, to_left int, to_right int, bytes binary"
PLACE_TYPES = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary()]
PLACE_NAMES = [part.split()[0] for part in PLACE.split(", ")]


# Of the columns of `anchor_table`, all anchors of a batch at a time.
KINDS = [np.int32, np.int32, np.uint64, np.uint64, np.int32, np.int32]


def split_keys(grams, contents, at, left, right):
    """Two keys in place of a hot anchor string, by the bytes to its right and to its left.

    A window that begins at most `SHARED_LEFT` bytes before the anchor holds `SHARED_RIGHT`
    bytes from it on, any other window more than `SHARED_LEFT` bytes before it: equal windows
    share one of the keys. A line in very many documents is so divided by what stands around.
    """
    keys = []
    for i in range(len(at)):
        content, place = contents[i], at[i]
        sides = (
            content[place : place + min(right[i], SHARED_RIGHT)],
            content[place - min(left[i], SHARED_LEFT) : place],
        )
        keys.append([xxhash.xxh64_intdigest(side, n) for n, side in enumerate(sides)])
    return mix(np.array(keys, np.uint64).reshape(-1, 2) + grams[:, None])


def repeated_places(rows: DataFrame, *grams: np.ndarray, combine: bool = True) -> DataFrame:
    """The anchors that pass the first filter, where they stand first in their batch, or with
    `combine` off at all their places.

    A later place with the context of an earlier one is a repeat whatever else there is; the
    runs of such places come as rows of their own, so a text of one word over and over, or
    copies, do not fill a task. Bytes come along where the second filter says that the anchor
    string may have several contexts. Strings that the third one knows as hot stand there
    under each of their `split_keys`.
    """
    filters = rows.sparkSession.sparkContext.broadcast(grams)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repeated, diverse, hot = filters.value
        for batch in batches:
            texts, doc_ids = encoded(batch.column("text")), batch.column("doc_id").to_numpy()
            parts = []
            for found in anchors_of(texts):
                kept = passes(repeated, found[2])
                parts.append(
                    [column[kept].astype(kind) for column, kind in zip(found, KINDS, strict=True)]
                )
            if not parts:
                continue
            columns = [np.concatenate(column) for column in zip(*parts, strict=True)]
            del parts
            text, at, grams, contexts, _, _ = columns
            order = np.lexsort([at, doc_ids[text], contexts, grams])
            for n, column in enumerate(columns):
                columns[n] = column[order]
            text, at, grams, contexts, left, right = columns
            del columns, order
            leaf, later = leaves_and_later(grams, contexts, doc_ids[text], at)
            if combine:
                runs = run_table(doc_ids[text[later]], (at - left)[later], (at + right)[later])
                yield place_batch(mix(runs[0].astype(np.uint64)), runs[0], runs[0], runs[1],
                                  np.full(len(runs[0]), RUN), runs[2] - runs[1])
                text, at, grams, contexts, left, right, leaf = (
                    column[leaf] for column in (text, at, grams, contexts, left, right, leaf)
                )
            several = passes(diverse, grams) & leaf
            many = np.flatnonzero(passes(hot, grams))
            if len(many):
                keys = split_keys(
                    grams[many], [texts[n] for n in text[many].tolist()], at[many].tolist(),
                    left[many].tolist(), right[many].tolist(),
                )
                grams[many] = keys[:, 0]
                twice = np.concatenate([np.arange(len(at)), many])
                text, at, contexts, left, right, several = (
                    column[twice] for column in (text, at, contexts, left, right, several)
                )
                grams = np.concatenate([grams, keys[:, 1]])
            for a in range(0, len(at), ROWS_AT_ONCE):
                part = slice(a, a + ROWS_AT_ONCE)
                stretches = [
                    bytes(texts[n][i - l : i + r]) if wanted else None
                    for n, i, l, r, wanted in zip(
                        *(c[part].tolist() for c in (text, at, left, right, several)), strict=True
                    )
                ]
                yield place_batch(grams[part], contexts[part], doc_ids[text[part]], at[part],
                                  left[part], right[part], stretches)

    return rows.mapInArrow(read, PLACE)


# In place of the length to the left: the row is a run of repeats, `to_right` bytes from `at`.
RUN = -1


def place_batch(gram, context, doc_id, at, left, right, stretches=None) -> pa.RecordBatch:
    values = (gram.view(np.int64), context.view(np.int64), doc_id, at, left, right)
    arrays = [
        pa.array(value.astype(np.int64)).cast(kind)
        for value, kind in zip(values, PLACE_TYPES[:6], strict=True)
    ]
    arrays.append(pa.array(stretches or [None] * len(at), pa.binary()))
    return pa.RecordBatch.from_arrays(arrays, PLACE_NAMES)


def leaves_and_later(gram, context, doc_id, at) -> tuple[np.ndarray, np.ndarray]:
    """For places in order of these columns: the first of each context, and the others except
    for the first place itself, met again."""
    new = np.ones(len(gram), bool)
    new[1:] = (gram[1:] != gram[:-1]) | (context[1:] != context[:-1])
    first_of = np.maximum.accumulate(np.where(new, np.arange(len(gram)), 0))
    later = ~new & ((doc_id != doc_id[first_of]) | (at != at[first_of]))
    return new, later


def run_table(doc_id, begin, end) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of stretches of one document that touch: document, begin, end."""
    order = np.lexsort([begin, doc_id])
    doc_id, begin, end = doc_id[order], begin[order], end[order]
    if not len(order):
        return doc_id, begin, end
    new_doc = np.ones(len(order), bool)
    new_doc[1:] = doc_id[1:] != doc_id[:-1]
    # Documents are set apart, so that one running maximum serves all.
    apart = (np.cumsum(new_doc) - 1) * (int(end.max()) + 2)
    reach = np.maximum.accumulate(end + apart)
    new = np.ones(len(order), bool)
    new[1:] = new_doc[1:] | (begin[1:] + apart[1:] > reach[:-1])
    heads = np.flatnonzero(new)
    lasts = np.append(heads[1:], len(order)) - 1
    return doc_id[heads], begin[heads], (reach - apart)[lasts]


# --- groups of places


def intervals(
    common: list[int], ranks: list[int]
) -> Iterator[tuple[int, int, int, int, list[int]]]:
    """The common-prefix intervals of a suffix array, inner before outer.

    `common[i]` is the length of the prefix shared with the suffix before, -1 where nothing
    is. Of each interval: its depth, its first suffix and the one after its last (all places
    of the string are between), the one with the smallest rank, and those that are no longer
    the smallest of their interval here, their deepest one with an earlier place.
    """
    stack: list[list] = []
    for i in range(1, len(common) + 1):
        depth = common[i] if i < len(common) else -1
        low = best = i - 1
        while stack and stack[-1][0] > depth:
            inner, low, other, later = stack.pop()
            best, lost = (best, other) if ranks[best] < ranks[other] else (other, best)
            later.append(lost)
            yield inner, low, i, best, later
        if depth < 0:
            continue
        if stack and stack[-1][0] == depth:
            other = stack[-1][2]
            best, lost = (best, other) if ranks[best] < ranks[other] else (other, best)
            stack[-1][2] = best
            stack[-1][3].append(lost)
        else:
            stack.append([depth, low, best, []])


def windows_of(table: np.ndarray, left: np.ndarray, right: np.ndarray, gram: np.ndarray):
    """Windows whose smallest gram is the anchor: row, start column, content hash, the byte
    before (256 at the start of a document), and whether it is the first of its row."""
    blocks = [
        windows_in(table[a : a + ROWS_AT_ONCE], left[a : a + ROWS_AT_ONCE],
                   right[a : a + ROWS_AT_ONCE], gram[a : a + ROWS_AT_ONCE], a)
        for a in range(0, len(table), ROWS_AT_ONCE)
    ]
    return [np.concatenate(column) for column in zip(*blocks, strict=True)]


def windows_in(table, left, right, gram, first_row: int):
    hashes = Hashes(table)
    grams = hashes.grams()
    column = np.arange(grams.shape[1])
    outside = (column < LEFT - left[:, None]) | (column + GRAM > LEFT + right[:, None])
    smaller = (grams < grams[:, LEFT : LEFT + 1]) & ~outside
    before = np.where(smaller[:, :LEFT], column[:LEFT], -1).max(1)
    after = np.where(smaller[:, LEFT:], column[LEFT:], CONTEXT + SPAN).min(1)
    first = np.maximum(np.maximum(before + 1, LEFT - left), 1)
    last = np.minimum(np.minimum(LEFT, after - SPAN), right + LEFT - LENGTH)
    count = np.maximum(last - first + 1, 0)
    row = np.repeat(np.arange(len(table)), count)
    start = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + first[row]
    content = mix(hashes.of(start, start + LENGTH, row) + gram[row])
    at_start = start == LEFT - left[row]
    byte_before = np.where(at_start, 256, table[row, start - 1].astype(np.int64))
    return (
        (row + first_row).astype(np.int32), start.astype(np.int16), content,
        byte_before.astype(np.int16), start == first[row],
    )


def context_repeats(leaves: dict) -> Iterator[tuple[np.ndarray, np.ndarray, list[int], list[int]]]:
    """Suffix arrays of left-diverse windows among the contexts of some anchor strings, about
    `WINDOWS_AT_ONCE` in each: leaf and start column of each suffix, common prefixes, and ranks
    by place. Suffixes that share a window are in one array, so no interval is divided."""
    # Wide enough for what follows the last window; nothing is zero.
    table = np.zeros((len(leaves["bytes"]), CONTEXT + TAIL), np.uint8)
    for i, (content, left) in enumerate(zip(leaves["bytes"], leaves["left"].tolist(), strict=True)):
        table[i, LEFT - left : LEFT - left + len(content)] = np.frombuffer(content, np.uint8)
    row, start, bucket = shared_windows(table, leaves)
    for part in whole_strings(bucket, WINDOWS_AT_ONCE):
        yield suffix_array(table, leaves, row[part], start[part], bucket[part])


def shared_windows(table: np.ndarray, leaves: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Left-diverse windows that stand at two places or more, equal ones together: row, start
    column, and a number for the content."""
    row, start, content, before, leading = windows_of(
        table[:, :CONTEXT], leaves["left"], leaves["right"], leaves["gram"].view(np.uint64)
    )
    order = np.argsort(content, kind="stable")
    content = content[order]
    new = np.concatenate([[True], content[1:] != content[:-1]])[: len(content)]
    head = np.flatnonzero(new)
    if not len(head):
        return row, start, order
    sizes = np.diff([*head, len(order)])
    before, leading = before[order], leading[order]
    alike = np.minimum.reduceat(before, head) == np.maximum.reduceat(before, head)
    # Left-extension diversity; the start of a document differs from any other byte.
    diverse = ~alike | (before[head] == 256) | np.logical_or.reduceat(leading, head)
    wanted = (sizes > 1) & diverse
    order = order[np.repeat(wanted, sizes)]
    return row[order], start[order], np.repeat(np.flatnonzero(wanted), sizes[wanted])


def suffix_array(table, leaves: dict, row, start, bucket):
    """The suffixes that begin with the given windows in order, and how they share prefixes."""
    length = (LEFT + leaves["right"][row] - LENGTH - start).astype(np.uint8)
    at = row.astype(np.int64) * table.shape[1] + start + LENGTH
    tails = np.lib.stride_tricks.sliding_window_view(table.ravel(), TAIL)[at]
    key = np.concatenate(
        [bucket.astype(">u8").view(np.uint8).reshape(-1, 8), tails, length[:, None]],
        axis=1,
    )
    array = np.argsort(np.ascontiguousarray(key).view(f"V{key.shape[1]}").ravel(), kind="stable")
    row, start, bucket = row[array], start[array], bucket[array]
    tails, length = tails[array], length[array]
    common = np.full(len(row), -1)
    if len(row) > 1:
        differs = tails[1:] != tails[:-1]
        agree = np.where(differs.any(1), differs.argmax(1), TAIL)
        shared = np.minimum(agree, np.minimum(length[1:], length[:-1]))
        common[1:] = np.where(bucket[1:] == bucket[:-1], shared, -1)
    ranks = np.empty(len(row), np.int64)
    ranks[np.lexsort([leaves["at"][row] + start, leaves["doc_id"][row]])] = np.arange(len(row))
    return row, start, common.tolist(), ranks.tolist()


def covered_in(places: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Document, start and end of repeats, for all places of some anchor strings."""
    is_run = places.column("to_left").to_numpy() == RUN
    doc_id, begin, size = (
        places.column(name).to_numpy()[is_run] for name in ("doc_id", "at", "to_right")
    )
    yield doc_id, begin, begin + size
    places = places.filter(pa.array(~is_run))
    columns = {name: places.column(name).to_numpy() for name in PLACE_NAMES[:6]}
    order = np.lexsort([columns[n] for n in ("at", "doc_id", "context", "gram")])
    gram, context, doc_id, at, left, right = (columns[n][order] for n in PLACE_NAMES[:6])
    if not len(order):
        return
    new_gram = np.concatenate([[True], gram[1:] != gram[:-1]])
    # Leaves of equal contexts: everything around a later place stands around the first.
    new_leaf, later = leaves_and_later(gram, context, doc_id, at)
    yield doc_id[later], (at - left)[later], (at + right)[later]

    head = np.flatnonzero(new_leaf)
    strings = np.cumsum(new_gram)[head]
    several = np.bincount(strings)[strings] > 1
    content, holder = contexts_of(places, order, new_leaf)
    chosen = np.flatnonzero(several & (holder >= 0))
    for doc, begin, found in suffix_arrays(
        gram, doc_id, at, left, right, content, holder[chosen], head[chosen], strings[chosen]
    ):
        late = [(n, best, depth) for depth, _, _, best, later in found for n in later]
        if late:
            late, best, depth = np.array(late).T
            # A window with its smallest gram twice is there by either anchor.
            other = (doc[late] != doc[best]) | (begin[late] != begin[best])
            late, depth = late[other], depth[other]
            # Windows next to each other overlap; their union is all that is asked.
            yield run_table(doc[late], begin[late], begin[late] + LENGTH + depth)


def groups_in(places: pa.Table) -> Iterator[tuple[np.ndarray, ...]]:
    """First document and start, length, document and start: all places of all repeats among
    the places of some anchor strings."""
    columns = {name: places.column(name).to_numpy() for name in PLACE_NAMES[:6]}
    order = np.lexsort([columns[n] for n in ("at", "doc_id", "context", "gram")])
    gram, context, doc_id, at, left, right = (columns[n][order] for n in PLACE_NAMES[:6])
    if not len(order):
        return
    new_gram = np.concatenate([[True], gram[1:] != gram[:-1]])
    new_leaf, _ = leaves_and_later(gram, context, doc_id, at)
    strings = np.cumsum(new_gram)
    content, holder = contexts_of(places, order, new_leaf)
    holder = holder[np.cumsum(new_leaf) - 1]
    chosen = np.flatnonzero((np.bincount(strings)[strings] > 1) & (holder >= 0))
    for doc, begin, found in suffix_arrays(
        gram, doc_id, at, left, right, content, holder[chosen], chosen, strings[chosen]
    ):
        for depth, low, high, best, _ in found:
            size = high - low
            # A window with its smallest gram twice is there by either anchor.
            if not ((doc[low:high] != doc[best]) | (begin[low:high] != begin[best])).any():
                continue
            yield (np.full(size, doc[best]), np.full(size, begin[best]),
                   np.full(size, LENGTH + depth), doc[low:high], begin[low:high])


def contexts_of(places: pa.Table, order: np.ndarray, new_leaf: np.ndarray):
    """The bytes column, and for every leaf a row that has its bytes, -1 without one."""
    content = places.column("bytes").combine_chunks()
    known = np.flatnonzero(np.asarray(content.is_valid())[order])
    holder = np.full(int(new_leaf.sum()), -1)
    holder[(np.cumsum(new_leaf) - 1)[known]] = order[known]
    return content, holder


def suffix_arrays(gram, doc_id, at, left, right, content, holder, rows, strings):
    """Document and start of the suffixes, and their intervals, for the chosen rows."""
    for part in whole_strings(strings, CONTEXTS_AT_ONCE):
        here = rows[part]
        leaves = {
            "gram": gram[here], "doc_id": doc_id[here], "left": left[here].astype(np.int64),
            "right": right[here].astype(np.int64), "at": at[here].astype(np.int64) - LEFT,
            "bytes": content.take(pa.array(holder[part])).to_pylist(),
        }
        for row, start, common, ranks in context_repeats(leaves):
            yield leaves["doc_id"][row], leaves["at"][row] + start, intervals(common, ranks)


def whole_strings(strings: np.ndarray, size: int) -> Iterator[slice]:
    """Slices of about `size` entries that do not divide a run of equal entries."""
    begin = 0
    while begin < len(strings):
        end = min(begin + size, len(strings))
        end = int(np.searchsorted(strings, strings[end - 1], side="right"))
        yield slice(begin, end)
        begin = end


COVER = "doc_id long, begin int, end int"


def covered(places: DataFrame) -> DataFrame:
    """`doc_id, begin, end` of repeats. Places meet by anchor string."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = list(batches)
        if not rows:
            return
        for doc_id, begin, end in covered_in(pa.Table.from_batches(rows)):
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc_id.astype(np.int64)), pa.array(begin.astype(np.int32)),
                 pa.array(end.astype(np.int32))],
                ["doc_id", "begin", "end"],
            )

    return places.repartition("gram").mapInArrow(scan, COVER)


def merged(begins: list[int], ends: list[int]) -> list[tuple[int, int]]:
    """Maximal runs; runs that touch are one."""
    runs: list[tuple[int, int]] = []
    for begin, end in sorted(zip(begins, ends, strict=True)):
        if runs and begin <= runs[-1][1]:
            runs[-1] = (runs[-1][0], max(end, runs[-1][1]))
        else:
            runs.append((begin, end))
    return runs


def searched(docs: DataFrame) -> DataFrame:
    """Documents that can hold a repeat."""
    rows = docs.where(F.col("doc_id").isNotNull()).select(
        F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")
    )
    return rows.where(F.octet_length("text") >= LENGTH)


GROUP = "first_doc_id long, first_start int, length int, doc_id long, start int"


def repeat_groups(docs: DataFrame) -> DataFrame:
    """All places of every maximal repeat, within the context of an anchor.

    A row per place: `doc_id, start`, with the repeat's length and its first place, which
    names the group. Every place of a group's string is there. Meant for inspection: unlike
    `repeat_spans` it keeps each place, so the places of one anchor string meet in one task.
    """
    rows = searched(docs)
    [known] = gram_filters(rows, repeated=F.lit(True))
    places = repeated_places(rows, known, known, np.zeros_like(known), combine=False)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = list(batches)
        if not found:
            return
        names = [part.split()[0] for part in GROUP.split(", ")]
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32()]
        for columns in groups_in(pa.Table.from_batches(found)):
            arrays = [pa.array(c.astype(np.int64)).cast(k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names)

    return places.repartition("gram").mapInArrow(scan, GROUP).distinct()


def repeat_spans(docs: DataFrame) -> DataFrame:
    """`doc_id, begins, ends`: overlapping stretches of bytes that also start earlier."""
    rows = searched(docs)
    filters = gram_filters(
        rows,
        repeated=F.lit(True),
        diverse=F.col("diverse"),
        hot=F.col("diverse") & (F.col("places") > HOT_PLACES),
    )
    places = repeated_places(rows, *filters)
    return (
        covered(places)
        .groupBy("doc_id")
        .agg(F.collect_list(F.struct("begin", "end")).alias("spans"))
        .select("doc_id", F.col("spans.begin").alias("begins"), F.col("spans.end").alias("ends"))
    )


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def remove_repeats(docs: DataFrame) -> DataFrame:
    """`doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept`, one row per row of `docs`.

    Of equal strings of `LENGTH` bytes the first, by (doc_id, start), stays; every byte covered
    by another one goes. Strings never cross documents and are judged on the input. Null text
    counts as empty. Rows that repeat doc_id and text are one document, each gets its result;
    if their texts differ, what is found in one is removed from all. A null doc_id takes no
    part and keeps its text. Other columns are ignored.
    """
    spans = repeat_spans(docs)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc_id, text, begins, ends in zip(
                *(c.to_pylist() for c in batch.columns), strict=True
            ):
                raw = text.encode()
                runs = [(a, min(b, len(raw))) for a, b in merged(begins or [], ends or []) if a < len(raw)]
                kept, at = [], 0
                for begin, end in runs:
                    kept.append(raw[at:begin])
                    at = end
                kept = b"".join([*kept, raw[at:]])
                gone = len(raw) - len(kept)
                out.append((doc_id, len(raw), gone, len(runs), hashlib.sha256(kept).hexdigest(), kept))
            columns = list(zip(*out, strict=True)) or [[]] * 6
            kinds = [pa.int64()] * 4 + [pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                [part.split()[0] for part in RESULT.split(", ")],
            )

    joined = rows.join(spans, "doc_id", "left").select("doc_id", "text", "begins", "ends")
    return joined.mapInArrow(cut, RESULT)


def digest(docs: DataFrame) -> DataFrame:
    return remove_repeats(docs).drop("kept")
