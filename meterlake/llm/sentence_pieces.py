"""SentencePiece encoding and decoding, for models trained by merges.

An Aho-Corasick automaton over all pieces reads a text once. At every position its output links
name the pieces that end there; each takes the best sum of scores up to its start one step
further, and the best of these sums is kept with its last piece. A step is allowed only from a
piece that it leaves as it is: merging the two alone, best-scored pairs first, must lead to the
same two. With this condition the best path is the model's own segmentation. Characters without
a piece take a step of their own, below all scores, and become byte pieces. The one exception
are words after a run of spaces: pieces of spaces have equal scores, so that their merges depend
on the whole run, and such a part is merged as a whole.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import itertools
import math
import re
import struct
import zlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from meterlake.llm.common import text_of
from meterlake.llm.packing import public_path

PACK = struct.Struct("<I").pack
SPACE = "▁"
MODEL = "piece_bpe_32k.model"
# Words that a worker remembers, with those of a block and as many from before; and pairs.
CACHE_ENTRIES, CACHE_PAIRS = 600_000, 500_000
# Characters whose words are in memory together.
BLOCK_CHARS = 1 << 21
BELOW_ALL = 10.0


class Pieces:
    """The pieces of a model, ready to encode and decode."""

    def __init__(self, scores: dict[str, tuple[int, float]], byte_ids: list[int]):
        self.byte_ids = byte_ids
        self.bytes_of = {i: bytes([b]) for b, i in enumerate(byte_ids)}
        self.bytes_of |= {i: p.replace(SPACE, " ").encode() for p, (i, _) in scores.items()}
        self.packed_of = {piece: PACK(i) for piece, (i, _) in scores.items()}
        self.scores = {piece: score for piece, (_, score) in scores.items()}
        self.unknown = min(self.scores.values(), default=0.0) - BELOW_ALL
        # Neighbours inside a piece, and the pieces that no merges divide.
        self.inner = {piece[i : i + 2] for piece in scores for i in range(len(piece) - 1)}
        self.whole = {piece for piece in scores if self.merged(piece) == [piece]}
        self.automaton = ahocorasick.Automaton()
        for piece in scores:
            if SPACE in piece.lstrip(SPACE) or "\n" in piece:
                raise ValueError("a piece reaches across words")
            if piece in self.whole:
                self.automaton.add_word(piece, (piece, self.scores[piece], len(piece) - 1))
        self.automaton.make_automaton()
        self.recent: dict[str, bytes] = {}
        self.earlier: dict[str, bytes] = {}
        self.pairs: dict[str, dict[str, bool]] = {}
        self.tried = 0

    # No piece reaches across these borders, so the encoding is divided there.
    chunk = re.compile(r" *[^ \n]+|\n| +")

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.packed(text), "<u4").tolist()

    def packed(self, text: str) -> bytes:
        """The ids as little-endian 32-bit numbers one after the other."""
        if not text:
            return b""
        if len(text) <= BLOCK_CHARS:
            chunks = self.chunk.findall(" " + text)
            return b"".join(map(self.codes(chunks).__getitem__, chunks))
        found = (match.group() for match in self.chunk.finditer(" " + text))
        parts = iter(lambda: list(itertools.islice(found, BLOCK_CHARS // 4)), [])
        return b"".join(b"".join(map(self.codes(part).__getitem__, part)) for part in parts)

    def codes(self, chunks: list[str]) -> dict[str, bytes]:
        """Packed ids by chunk, for these and others met before."""
        if len(self.recent) > CACHE_ENTRIES:
            self.recent, self.earlier = {}, self.recent
        for chunk in set(chunks).difference(self.recent):
            known = self.earlier.get(chunk)
            if known is None:
                known = self.encode_chunk(chunk)
            self.recent[chunk] = known
        return self.recent

    def encode_chunk(self, chunk: str) -> bytes:
        if SPACE not in chunk:
            return self.encode_part(chunk)
        first, *others = chunk.split(SPACE)  # the mark itself, in a text, is not a space
        mark = self.in_bytes(SPACE)
        return self.encode_part(first) + b"".join(mark + self.encode_part(part) for part in others)

    def encode_part(self, part: str) -> bytes:
        text = part.replace(" ", SPACE)
        # Runs of spaces have equal scores, so that their merges depend on the whole run.
        pieces = self.merged(text) if text.startswith(2 * SPACE) else self.relaxed(text)
        return b"".join([self.packed_of.get(piece) or self.in_bytes(piece) for piece in pieces])

    def relaxed(self, text: str) -> list[str]:
        """The best path through a text without a run of spaces."""
        pairs, nothing, size = self.pairs, -math.inf, len(text)
        # By place: the best sum, its last piece, and what is known of pieces after that one.
        sums, last, after = [0.0], [""], [pairs.setdefault("", {})]
        place, best, found = 0, nothing, ""
        for end, match in itertools.chain(self.automaton.iter(text), [(size, None)]):
            while place < end:  # no more pieces end here
                if best == nothing:  # a character without a piece stands alone
                    best, found = sums[place] + self.unknown, text[place]
                sums.append(best)
                last.append(found)
                known = pairs.get(found)
                after.append(pairs.setdefault(found, {}) if known is None else known)
                place, best = place + 1, nothing
            if match is None:
                break
            piece, score, back = match
            start = end - back
            total = sums[start] + score
            if total > best:
                apart = after[start].get(piece)
                if apart is None:
                    apart = after[start][piece] = self.stay_apart(last[start], piece)
                if apart:
                    best, found = total, piece
        pieces = []
        while place:
            pieces.append(last[place])
            place -= len(last[place])
        return pieces[::-1]

    def stay_apart(self, before: str, piece: str) -> bool:
        """Whether the merges of two pieces in a row lead to these two."""
        self.tried += 1
        if self.tried > CACHE_PAIRS:
            self.tried = 0
            self.pairs.clear()
        if not before or before[-1] + piece[0] not in self.inner:
            return True  # no merge can cross
        joined = before + piece
        return joined not in self.whole and self.merged(joined) == [before, piece]

    def merged(self, text: str) -> list[str]:
        """The pieces of a text by merges, the best-scored first, of equal ones the leftmost."""
        parts: list[str] = list(text)
        after = list(range(1, len(parts) + 1))
        before = list(range(-1, len(parts) - 1))
        waiting: list[tuple[float, int, int, int]] = []

        def offer(left: int, right: int) -> None:
            joined = parts[left] + parts[right]
            if (score := self.scores.get(joined)) is not None:
                heapq.heappush(waiting, (-score, left, right, len(joined)))

        for right in range(1, len(parts)):
            offer(right - 1, right)
        while waiting:
            _, left, right, size = heapq.heappop(waiting)
            # Either may have been merged with another one since.
            if not parts[left] or not parts[right] or len(parts[left]) + len(parts[right]) != size:
                continue
            parts[left] += parts[right]
            parts[right] = ""
            after[left] = after[right]
            if after[left] < len(parts):
                before[after[left]] = left
                offer(left, after[left])
            if before[left] >= 0:
                offer(before[left], left)
        return [part for part in parts if part]

    def in_bytes(self, text: str) -> bytes:
        return b"".join(PACK(self.byte_ids[b]) for b in text.encode())

    def decode(self, ids: list[int]) -> str:
        return self.decoded(ids).decode()

    def decoded(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))[1:]


@functools.cache
def load_pieces(model: str | None = None) -> Pieces:
    """Pieces and scores of a model file; control pieces are never encoded."""
    import sentencepiece

    read = sentencepiece.SentencePieceProcessor(model_file=model or public_path(MODEL))
    plain = [
        i
        for i in range(read.get_piece_size())
        if not (read.is_byte(i) or read.is_control(i) or read.is_unknown(i) or read.is_unused(i))
    ]
    scores = {read.id_to_piece(i): (i, read.get_score(i)) for i in plain}
    return Pieces(scores, [read.piece_to_id(f"<0x{b:02X}>") for b in range(256)])


def encode(docs: DataFrame, model: str | None = None) -> DataFrame:
    """`doc_id, ids` for every row. Null and empty texts have no ids; a text is read whole,
    whatever its length. Other columns are ignored."""

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = load_pieces(model)
        for batch in batches:
            ids = [pieces.encode(text) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"]
            )

    return rows_of(docs).mapInArrow(encoded, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, model: str | None = None) -> DataFrame:
    """`doc_id, text` for every row of `doc_id, ids`; null ids count as none."""

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = load_pieces(model)
        for batch in batches:
            texts = [pieces.decode(ids or []) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"]
            )

    return encoded.select("doc_id", "ids").mapInArrow(decoded, "doc_id long, text string")


def digest(docs: DataFrame, model: str | None = None) -> DataFrame:
    """`doc_id, n_ids, ids_crc32, decoded_sha256`: every text encoded and decoded again."""

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = load_pieces(model)
        for batch in batches:
            counts, sums, shas = [], [], []
            for text in batch.column("text").to_pylist():
                packed = pieces.packed(text)
                ids = np.frombuffer(packed, "<u4").tolist()
                counts.append(len(ids))
                sums.append(zlib.crc32(packed))
                shas.append(hashlib.sha256(pieces.decoded(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(sums, pa.int64()),
                 pa.array(shas, pa.string())],
                ["doc_id", "n_ids", "ids_crc32", "decoded_sha256"],
            )

    schema = "doc_id long, n_ids long, ids_crc32 long, decoded_sha256 string"
    return rows_of(docs).mapInArrow(digested, schema)


def rows_of(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
