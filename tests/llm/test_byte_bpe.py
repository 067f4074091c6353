"""Byte-level BPE against the tiktoken library and plain Python."""

from __future__ import annotations

import base64
import hashlib
import random
from pathlib import Path

import numpy as np
import pytest

from meterlake.llm import byte_bpe
from meterlake.llm.queries import QUERIES

public_tokenizers = pytest.importorskip("public_tokenizers")
SF_DIR = "/root/testdata/sf0.01"
needs_tables = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def library():
    import tiktoken

    with open(public_tokenizers.path(byte_bpe.RANKS), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


def ids_of(codec, texts):
    return [np.frombuffer(ids, "<u4").tolist() for ids in codec.encode(texts)]


AWKWARD = [
    "", " ", "\n\n  \n", "a", "don't they'll", "  two  spaces ", "naïve Straße 中文 ١٢٣ é",
    "<|endoftext|>", "\x00\x01﻿", "🙂🙂🏽‍🦰", "x" * 5000, " " * 5000, "ab" * 3000, "é中" * 2000,
]


def test_perfect_hash_has_one_place_for_every_key():
    ranks = {f"key{n}".encode(): 7 * n for n in range(5000)}
    table = byte_bpe.PerfectHash.of(ranks)
    assert sorted(table.keys) == sorted(ranks)
    assert table.find(list(ranks)).tolist() == list(ranks.values())
    assert (table.find([f"other{n}".encode() for n in range(5000)]) == -1).all()
    assert byte_bpe.PerfectHash.of({b"a": 3}).find([b"a", b"b", b""]).tolist() == [3, -1, -1]
    assert byte_bpe.PerfectHash.of({}).find([b"a"]).tolist() == [-1]


def plain_merge(ranks, token):
    """Join the leftmost pair of the lowest rank until no pair has one."""
    parts = [token[i : i + 1] for i in range(len(token))]
    while pairs := [
        (ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks
    ]:
        _, at = min(pairs)
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return [ranks[part] for part in parts]


@pytest.mark.parametrize("seed", range(5))
def test_merges_of_random_vocabularies(seed):
    draw = random.Random(seed)
    words = {bytes([c]) for c in b"abc"}
    while len(words) < 60:
        words.add(draw.choice(sorted(words)) + draw.choice(sorted(words)))
    singles = [bytes([c]) for c in b"abc"]
    rest = sorted(words - set(singles))
    draw.shuffle(rest)
    ranks = {word: n for n, word in enumerate(singles + rest)}
    codec = byte_bpe.Codec(ranks, r".+")
    for _ in range(300):
        token = bytes(draw.choices(b"abc", k=draw.randrange(1, 40)))
        assert codec.merged(token) == plain_merge(ranks, token)


def test_ids_are_those_of_the_library(library):
    codec = byte_bpe.load_codec()
    assert ids_of(codec, AWKWARD) == [library.encode_ordinary(text) for text in AWKWARD]
    draw = random.Random(3)
    texts = ["".join(draw.choices("ab  \n'stl.éñ中1 \U0001f642", k=n)) for n in range(400)]
    found = ids_of(codec, texts)
    assert found == [library.encode_ordinary(text) for text in texts]
    assert [codec.decode(ids).decode() for ids in found] == texts


def test_long_texts_in_parts_and_small_memory(library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "BLOCK_CHARS", 100)
    monkeypatch.setattr(byte_bpe, "REMEMBERED", 3)
    codec = byte_bpe.Codec(dict(library._mergeable_ranks), public_tokenizers.PATTERN)
    texts = ["words that go on, " * 200, "short", "", "don't  \n\n stop " * 90]
    assert ids_of(codec, texts) == [library.encode_ordinary(text) for text in texts]


@needs_tables
def test_query_equals_the_library(spark, library):
    texts = dict(spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect())
    rows = QUERIES["op13_byte_bpe"](spark, SF_DIR).collect()
    assert len(rows) == len(texts)
    for row in rows:
        text = texts[row.doc_id] or ""
        ids = library.encode_ordinary(text)
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_awkward_tables(spark, library):
    """Nulls, repeated rows, clashing columns and no rows."""
    schema = "doc_id long, text string, ids int, decoded string"
    rows = [(1, None, 1, "a"), (2, "", 2, None), (None, "a b", 3, "b"), (2, "a b", 4, "c")] * 2
    docs = spark.createDataFrame(rows, schema)
    both = byte_bpe.decode(byte_bpe.encode(docs)).collect()
    assert sorted((str(r.doc_id), r.ids, bytes(r.decoded)) for r in both) == sorted(
        (str(i), library.encode_ordinary(text or ""), (text or "").encode()) for i, text, _, _ in rows
    )
    found = byte_bpe.digest(docs).collect()
    assert sorted(r.n_tokens for r in found) == [0, 0, 0, 0, 2, 2, 2, 2]
    empty = hashlib.sha256(b"").hexdigest()
    assert {(r.ids_sha256, r.decoded_sha256) for r in found if not r.n_tokens} == {(empty, empty)}
    assert byte_bpe.digest(docs.limit(0)).collect() == []
    none = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert [bytes(r.decoded) for r in byte_bpe.decode(none).collect()] == [b"", b""]
