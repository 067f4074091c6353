"""Byte-level BPE: texts to ids and back.

A text is split into pre-tokens. A block of texts looks its distinct pre-tokens up in a minimal
perfect hash of the vocabulary, all at once; one that is in the vocabulary is one id. Only the
others are merged: their bytes are linked in a list, a heap holds the pairs of neighbours that
the vocabulary has, and the pair of the lowest rank is joined until none is left.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import heapq
import itertools
import struct
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame, functions as F

from meterlake.llm.common import documents, text_of

RANKS = "byte_bpe_multi_50k.tiktoken"
# Characters that a task splits at a time; the pre-tokens of a block are in memory together.
BLOCK_CHARS = 1 << 21
# Pre-tokens that a worker remembers: this many and those of a block, and as many from before.
REMEMBERED = 300_000
KEYS_PER_BUCKET = 4
PACK = struct.Struct("<I").pack
MIX, STIR = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93


@dataclass(frozen=True)
class PerfectHash:
    """Exactly one place for every key, without gaps.

    A key's bucket names the shift that leads its keys to places of their own; the bucket of a
    single key may name the place itself, as -1 - place.
    """

    shifts: np.ndarray
    keys: list[bytes]
    ids: np.ndarray

    @classmethod
    def of(cls, ranks: dict[bytes, int]) -> PerfectHash:
        tokens = list(ranks)
        hashes = hashes_of(tokens)
        if len(np.unique(hashes)) < len(tokens):
            raise ValueError("two keys share a 64-bit hash")
        shifts = np.zeros(max(1, len(tokens) // KEYS_PER_BUCKET), np.int64)
        buckets = (hashes % np.uint64(len(shifts))).astype(np.int64)
        order = np.argsort(buckets, kind="stable")
        firsts = np.searchsorted(buckets[order], np.arange(len(shifts) + 1))
        sizes = np.diff(firsts)
        owner = np.full(len(tokens), -1, np.int64)
        for bucket in np.argsort(-sizes, kind="stable")[: np.count_nonzero(sizes > 1)]:
            members = order[firsts[bucket] : firsts[bucket + 1]]
            shifts[bucket], places = free_places(hashes[members], owner)
            owner[places] = members
        singles = np.flatnonzero(sizes == 1)
        left = np.flatnonzero(owner < 0)
        owner[left] = order[firsts[singles]]
        shifts[singles] = -1 - left
        return cls(shifts, [tokens[k] for k in owner], np.array([ranks[tokens[k]] for k in owner]))

    def find(self, tokens: list[bytes]) -> np.ndarray:
        """The id of every token, -1 for those that are no key."""
        if not tokens or not self.keys:
            return np.full(len(tokens), -1)
        hashes = hashes_of(tokens)
        shifts = self.shifts[hashes % np.uint64(len(self.shifts))]
        places = np.where(shifts < 0, -1 - shifts, places_of(hashes, shifts, len(self.keys)))
        same = [self.keys[place] == token for place, token in zip(places.tolist(), tokens)]
        return np.where(same, self.ids[places], -1)


def hashes_of(tokens: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, tokens), np.uint64, len(tokens))


def places_of(hashes: np.ndarray, shifts: np.ndarray, size: int) -> np.ndarray:
    mixed = (hashes ^ (shifts.astype(np.uint64) * np.uint64(MIX))) * np.uint64(STIR)
    return ((mixed >> np.uint64(32)) % np.uint64(size)).astype(np.int64)


def free_places(hashes: np.ndarray, owner: np.ndarray) -> tuple[int, np.ndarray]:
    """The first shift that leads all hashes to places that are free and differ."""
    for start in itertools.count(0, 256):
        shifts = np.arange(start, start + 256)[:, None]
        places = np.sort(places_of(hashes, shifts, len(owner)), axis=1)
        fits = (owner[places] < 0).all(1) & (np.diff(places, axis=1) > 0).all(1)
        if fits.any():
            shift = start + int(np.argmax(fits))
            return shift, places_of(hashes, np.array([shift]), len(owner))


class Codec:
    """Encoder and decoder of one vocabulary of byte strings with ranks, which are the ids."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.pattern = regex.compile(pattern)
        self.hash = PerfectHash.of(ranks)
        # Ranks of what a merge can make. The heap asks for one pair at a time.
        self.rank_of = ranks.get
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.name_of = {rank: str(rank) for rank in self.bytes_of}
        self.recent: dict[str, bytes] = {}
        self.earlier: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """Ids of every text, as little-endian 32-bit numbers one after the other."""
        for some in blocks(texts):
            if len(some) == 1 and len(some[0]) > BLOCK_CHARS:
                parts = self.parts(some[0])
                yield b"".join(b"".join(map(self.codes(part).__getitem__, part)) for part in parts)
                continue
            split = [self.pattern.findall(text) for text in some]
            codes = self.codes(itertools.chain.from_iterable(split))
            for tokens in split:
                yield b"".join(map(codes.__getitem__, tokens))

    def parts(self, text: str) -> Iterator[list[str]]:
        found = (match.group() for match in self.pattern.finditer(text))
        while part := list(itertools.islice(found, BLOCK_CHARS // 4)):
            yield part

    def codes(self, tokens: Iterable[str]) -> dict[str, bytes]:
        """Packed ids by pre-token, for these and others met before."""
        if len(self.recent) > REMEMBERED:
            self.recent, self.earlier = {}, self.recent
        new = []
        for token in set(tokens).difference(self.recent):
            known = self.earlier.get(token)
            if known is None:
                new.append(token)
            else:
                self.recent[token] = known
        raw = [token.encode() for token in new]
        for token, data, whole in zip(new, raw, self.hash.find(raw).tolist()):
            ids = [whole] if whole >= 0 else self.merged(data)
            self.recent[token] = b"".join(map(PACK, ids))
        return self.recent

    def merged(self, token: bytes) -> list[int]:
        """Ids of a byte string: the pair of neighbours of the lowest rank is joined, the
        leftmost of equal ones, as long as a pair has a rank."""
        rank_of, size = self.rank_of, len(token)
        ends = list(range(1, size + 1))  # of the part that starts here; 0 once joined
        before = list(range(-1, size))
        heap = []
        for at in range(size - 1):
            rank = rank_of(token[at : at + 2])
            if rank is not None:
                heap.append((rank, at, at + 2))
        heapq.heapify(heap)
        while heap:
            rank, at, stop = heapq.heappop(heap)
            middle = ends[at]
            # Stale: a part of this pair has been joined to something else meanwhile.
            if not middle or middle >= stop or ends[middle] != stop:
                continue
            ends[at], ends[middle] = stop, 0
            before[stop] = at
            if stop < size:
                rank = rank_of(token[at : ends[stop]])
                if rank is not None:
                    heapq.heappush(heap, (rank, at, ends[stop]))
            if at:
                left = before[at]
                rank = rank_of(token[left:stop])
                if rank is not None:
                    heapq.heappush(heap, (rank, left, stop))
        ids, at = [], 0
        while at < size:
            ids.append(rank_of(token[at : ends[at]]))
            at = ends[at]
        return ids

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


def blocks(texts: list[str]) -> Iterator[list[str]]:
    """The texts in runs of about `BLOCK_CHARS` characters; a longer one stands alone."""
    run, size = [], 0
    for text in texts:
        if run and size + len(text) > BLOCK_CHARS:
            yield run
            run, size = [], 0
        run.append(text)
        size += len(text)
    if run:
        yield run


@functools.cache
def load_codec(path: str | None = None, pattern: str | None = None) -> Codec:
    """Built once per worker, from a file of base64 byte strings and ranks."""
    import public_tokenizers

    with open(path or public_tokenizers.path(RANKS), "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return Codec(ranks, pattern or public_tokenizers.PATTERN)


def encode(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """`doc_id, ids` for every row, repeated rows included.

    Null and empty texts have no ids; a text is read whole, whatever its length. Rows without a
    doc_id keep null. Other columns are ignored, whatever their names. There are no special
    tokens: their strings are ordinary text.
    """

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = load_codec(path, pattern)
        for batch in batches:
            ids = codec.encode(batch.column("text").to_pylist())
            yield from in_blocks(batch.column("doc_id"), ids)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return rows.mapInArrow(encoded, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """`doc_id, ids, decoded` for every row of `doc_id, ids`: the bytes that the ids stand for.

    Null ids count as none. An id that the vocabulary lacks is an error.
    """

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = load_codec(path)
        for batch in batches:
            ids = batch.column("ids")
            raw = [codec.decode(numbers) for numbers in numbers_of(ids)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), ids, pa.array(raw, pa.binary())], ["doc_id", "ids", "decoded"]
            )

    rows = encoded.select("doc_id", "ids")
    return rows.mapInArrow(decoded, "doc_id long, ids array<int>, decoded binary")


def numbers_of(ids: pa.ListArray) -> Iterator[list[int]]:
    """Each row's ids; `flatten` leaves null rows out, whose length counts as none."""
    sizes = ids.value_lengths().fill_null(0).to_numpy()
    values = ids.flatten().to_numpy()
    for end, size in zip(np.cumsum(sizes).tolist(), sizes.tolist()):
        yield values[end - size : end].tolist()


def in_blocks(doc_ids: pa.Array, packed: Iterable[bytes]) -> Iterator[pa.RecordBatch]:
    """Batches of about `BLOCK_CHARS` ids, so that long texts do not pile up in one."""

    def block(at: int, run: list[bytes]) -> pa.RecordBatch:
        ends = np.cumsum([0] + [len(ids) // 4 for ids in run])
        values = np.frombuffer(b"".join(run), "<i4")
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, pa.int32()))
        return pa.RecordBatch.from_arrays([doc_ids[at : at + len(run)], lists], ["doc_id", "ids"])

    at, run, size = 0, [], 0
    for ids in packed:
        run.append(ids)
        size += len(ids)
        if size > 4 * BLOCK_CHARS:
            yield block(at, run)
            at, run, size = at + len(run), [], 0
    if run:
        yield block(at, run)


def digest(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """`doc_id, n_tokens, ids_sha256, decoded_sha256` of every row: encoded, and decoded again.

    As `encode` and `decode` one after the other, but the ids stay in the worker. A null or
    empty text has no tokens and the checksums of an empty string; a table without rows gives
    none.
    """

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = load_codec(path, pattern)
        for batch in batches:
            rows = []
            for packed in codec.encode(batch.column("text").to_pylist()):
                ids = np.frombuffer(packed, "<u4").tolist()
                named = ",".join(map(codec.name_of.__getitem__, ids)).encode()
                rows.append((len(ids), sha256_of(named), sha256_of(codec.decode(ids))))
            counts, ids_sums, text_sums = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(ids_sums, pa.string()),
                 pa.array(text_sums, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return rows.mapInArrow(
        digested, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )


def sha256_of(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def query(spark, sf_dir: str) -> DataFrame:
    return digest(documents(spark, sf_dir))
