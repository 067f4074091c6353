"""Ranked lexical search against plain Python and SQL."""

from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest
from compare import connect, difference

from meterlake.llm import lexical
from meterlake.llm.queries import ORACLE_SQL, QUERIES

SF_DIR = "/root/testdata/sf0.01"
needs_tables = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")
DOCS, ITEMS = "doc_id long, text string, n int, terms string", "item_id long, text string, rank int"


def words(text):
    lowered = re.sub("[A-Z]", lambda letter: letter[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lowered)


def plain_search(docs, items, k):
    counts = [(doc_id, Counter(words(text))) for doc_id, text in docs]
    sizes = [sum(found.values()) for _, found in counts]
    n_docs, total = sum(size > 0 for size in sizes), sum(sizes)
    df = Counter(term for _, found in counts for term in found)
    asked = defaultdict(set)
    for item, text in items:
        asked[item] |= set(words(text))
    rows = []
    for item, terms in asked.items():
        scored = []
        for (doc_id, found), size in zip(counts, sizes):
            score = 0
            for term in terms & set(found):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[term] + 1)))
                m = 100 - 90 + (90 * size * n_docs) // total
                score += w * ((10**9 * found[term]) // (1000 * found[term] + 8 * m))
            if score > 0:
                scored.append((-score, doc_id is not None, doc_id or 0))
        for rank, (score, named, doc_id) in enumerate(sorted(scored)[:k], 1):
            rows.append((item, rank, doc_id if named else None, -score))
    return Counter(rows)


def found_by(spark, docs, items, **settings):
    rows = lexical.search(
        spark.createDataFrame([(*row, 1, "x") for row in docs], DOCS),
        spark.createDataFrame([(*row, 2) for row in items], ITEMS),
        **settings,
    ).collect()
    return Counter(map(tuple, rows))


@pytest.mark.parametrize("seed, block, short", [(1, 4096, 1 / 32), (2, 16, 1 / 4), (3, 7, 0), (4, 16, 1)])
def test_equals_plain_version(spark, monkeypatch, seed, block, short):
    """Blocks of few documents, so that bars and bounds decide, with lists all short or long."""
    draw = random.Random(seed)
    vocabulary = [f"w{n}" for n in range(60)] + ["É", "é", "ß中", "x1"]
    spread = [1 / (1 + n) for n in range(len(vocabulary))]
    docs = [
        (draw.randrange(300), " ".join(draw.choices(vocabulary, spread, k=draw.randrange(40))))
        for _ in range(400)
    ]
    items = [(n, " ".join(draw.choices(vocabulary, k=draw.randrange(12)))) for n in range(25)]
    monkeypatch.setattr(lexical, "BLOCK_DOCS", block)
    monkeypatch.setattr(lexical, "SHORT_SHARE", short)
    assert found_by(spark, docs, items, k=5) == plain_search(docs, items, 5)


def test_bars_leave_nothing_out():
    """One task, many blocks: every document that could be among the best is met."""
    draw = np.random.default_rng(5)
    searcher = lexical.Searcher(lexical.Asked({}, [7], [np.arange(6)]), np.array([9, 5, 5, 2, 1, 1]), 3)
    everything = []
    for start in range(0, 2000, 50):
        rows = [np.flatnonzero(draw.random(6) < [0.01, 0.1, 0.3, 0.5, 0.9, 0.9]) for _ in range(50)]
        counts = [draw.integers(1, 4, len(row)) for row in rows]
        block = lexical.pa.RecordBatch.from_arrays(
            [lexical.pa.array(range(start, start + 50)), lexical.pa.array([100] * 50),
             lexical.lists_of(rows, lexical.pa.int32()), lexical.lists_of(counts, lexical.pa.int64())],
            ["doc_id", "m", "terms", "counts"],
        )
        searcher.add(block)
        for n, (row, count) in enumerate(zip(rows, counts)):
            parts = searcher.weight[row] * (10**9 * count // (1000 * count + 800))
            everything.append((-int(parts.sum()), start + n))
    ids, scores = searcher.best[0]
    assert [(-s, i) for i, s in zip(ids.tolist(), scores.tolist())] == sorted(everything)[:3]


def test_awkward_rows(spark):
    """Null and empty texts, null and repeated ids, ties, repeated rows, clashing columns."""
    docs = [
        (5, "alpha beta"), (5, "alpha beta"), (5, "gamma alpha"), (None, "alpha beta"), (3, "alpha beta"),
        (9, None), (8, ""), (7, "... !!"), (6, "delta " * 3000 + "alpha"), (4, "ALPHA-Beta É"),
        *((n, "filler words") for n in range(20, 60)),
    ]
    items = [(1, "beta ALPHA"), (1, "gamma"), (None, "delta"), (2, None), (3, ""), (4, "unheard"), (5, "é É")]
    assert found_by(spark, docs, items, k=10) == plain_search(docs, items, 10)
    # Items in several rounds are the same items.
    assert found_by(spark, docs, items, k=10, round_terms=2) == plain_search(docs, items, 10)


def test_no_rows(spark):
    docs, items = [(1, "a b")], [(1, "a")]
    assert not found_by(spark, [], items)
    assert not found_by(spark, docs, [])
    assert not found_by(spark, [(1, None)], items)
    assert not found_by(spark, docs, [(1, "...")])


def test_long_texts_are_split_in_parts(monkeypatch):
    monkeypatch.setattr(lexical, "PART_BYTES", 10)
    for text in ("", "one two three four five", "averyveryverylongword " * 3, "x" * 35, " " * 30, "Ab-cd é中"):
        found = [word.decode() for part in lexical.words_of(text) for word in part]
        assert found == words(text)


@needs_tables
def test_query_equals_sql(spark):
    rows = QUERIES["op12_lexical_search"](spark, SF_DIR)
    assert difference(rows, connect(SF_DIR), ORACLE_SQL["op12_lexical_search"]) == ""
