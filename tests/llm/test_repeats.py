"""Repeat removal against a table of all windows, on texts made of shared parts."""

from __future__ import annotations

import hashlib
import tracemalloc
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

from meterlake.llm import repeats

SCHEMA = "doc_id long, text string, source string"


def plain(texts: dict) -> dict:
    seen, out = set(), {}
    for doc_id in sorted(texts):
        raw = (texts[doc_id] or "").encode()
        gone = np.zeros(len(raw) + 1, bool)
        for at in range(len(raw) - repeats.LENGTH + 1):
            window = raw[at : at + repeats.LENGTH]
            if window in seen:
                gone[at : at + repeats.LENGTH] = True
            seen.add(window)
        spans = int(np.sum(gone[:-1] & ~np.concatenate([[False], gone[:-2]]))) if raw else 0
        kept = bytes(np.frombuffer(raw, np.uint8)[~gone[:-1]])
        out[doc_id] = (len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    return out


def found(spark, texts: dict) -> dict:
    rows = [(i, text, "s") for i, text in texts.items()]
    result = repeats.digest(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    return {r.doc_id: tuple(r)[1:] for r in result}


def words(draw, n):
    return " ".join("".join(draw.choice(list("abcdeé"), draw.integers(1, 7))) for _ in range(n))


@pytest.mark.parametrize("seed,hot", [(0, 500), (1, 500), (2, 500), (0, 3), (1, 1)])
def test_shared_parts(spark, monkeypatch, seed, hot):
    """With few places to be hot, anchors are divided by what stands around them."""
    monkeypatch.setattr(repeats, "HOT_PLACES", hot)
    draw = np.random.default_rng(seed)
    passages = [words(draw, n) for n in (8, 18, 22, 25, 30, 40, 60, 200)]
    line = "a line that very many of the documents have in common but short\n"
    texts = {}
    for i in range(120):
        parts = [words(draw, int(draw.integers(0, 30)))]
        for _ in range(draw.integers(0, 4)):
            parts.append(passages[draw.integers(len(passages))])
            parts.append(line * int(draw.integers(0, 2)) + words(draw, int(draw.integers(0, 12))))
        text = "".join(parts)
        if draw.random() < 0.3 and texts:  # a near copy: one place changed
            text = texts[int(draw.integers(len(texts)))] or "x"
            at = int(draw.integers(len(text)))
            text = text[:at] + "#" + text[at + int(draw.integers(0, 3)) :]
        texts[i] = text
    assert found(spark, texts) == plain(texts)


def test_awkward_texts(spark):
    draw = np.random.default_rng(9)
    long = words(draw, 300)
    texts = {
        1: None, 2: "", 3: "short", 4: "a" * 99, 5: "a" * 100, 6: "a" * 101, 7: "a" * 700,
        8: "ab" * 300, 9: "ab" * 120 + long, 10: long, 11: long, 12: long + long, 13: long[50:-50],
        14: "é" * 80 + long[:99], 15: "anre, " * 60, 16: "x" + "anre, " * 60 + "y",
    }
    assert found(spark, texts) == plain(texts)


def test_rows_without_and_with_repeated_id(spark):
    text = words(np.random.default_rng(4), 60)
    rows = [(None, text), (5, text), (5, text), (6, text)]
    result = repeats.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    gone = sorted((r.doc_id or 0, r.n_removed > 0) for r in result)
    assert gone == [(0, False), (5, False), (5, False), (6, True)]


def test_groups_hold_every_place(spark):
    draw = np.random.default_rng(5)
    passages = [words(draw, n) for n in (30, 45, 70)]
    texts = {
        i: words(draw, 5) + passages[i % 3][: 110 + 5 * i] + words(draw, 4) + passages[i % 2]
        for i in range(12)
    }
    texts |= {20: texts[3], 21: texts[3], 22: "ab" * 120}
    raw = {i: text.encode() for i, text in texts.items()}
    docs = spark.createDataFrame([(i, t, "s") for i, t in texts.items()], SCHEMA)
    groups = {}
    for r in repeats.repeat_groups(docs.repartition(3)).collect():
        key = r.first_doc_id, r.first_start, r.length
        groups.setdefault(key, set()).add((r.doc_id, r.start))
    for (doc_id, start, length), places in groups.items():
        string = raw[doc_id][start : start + length]
        everywhere = {
            (i, at) for i, b in raw.items() for at in range(len(b)) if b[at : at + length] == string
        }
        assert len(string) == length >= 100 and places == everywhere and len(places) > 1
        assert (doc_id, start) == min(places)
    covered = {i: np.zeros(len(b), bool) for i, b in raw.items()}
    for (doc_id, start, length), places in groups.items():
        for i, at in places - {(doc_id, start)}:
            covered[i][at : at + length] = True
    expected = plain(texts)
    assert {i: int(c.sum()) for i, c in covered.items()} == {i: v[1] for i, v in expected.items()}


def test_contexts_of_a_common_passage_are_sorted_in_slices():
    """One anchor string with 3,000 contexts, each with a place of its own that differs: nearly
    all of its windows repeat."""
    draw = np.random.default_rng(11)
    passage = words(draw, 80).encode()[: repeats.CONTEXT + 20]
    texts = []
    for i in range(3000):
        at = int(draw.integers(len(passage)))
        texts.append(b"%d" % i + passage[:at] + b"#" + passage[at + 1 :])
    text, at, gram, context, left, right = map(
        np.concatenate, zip(*repeats.anchors_of(texts), strict=True)
    )
    string = np.bincount(np.unique(gram, return_inverse=True)[1]).argmax()
    one = gram == np.unique(gram)[string]
    text, at, gram, context, left, right = (
        column[one] for column in (text, at, gram, context, left, right)
    )
    stretches = [texts[n][i - l : i + r] for n, i, l, r in zip(text, at, left, right, strict=True)]
    places = pa.Table.from_batches(
        [repeats.place_batch(gram, context, text, at, left, right, stretches)]
    )
    tracemalloc.start()
    found = [columns for columns in repeats.covered_in(places) if len(columns[0])]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # Touching stretches come as one row.
    assert 2000 < sum(len(columns[0]) for columns in found) < 2 * len(at)
    assert peak < 60e6


@pytest.mark.parametrize("windows", [1, 7, 100])
def test_slices_change_nothing(spark, monkeypatch, windows):
    monkeypatch.setattr(repeats, "WINDOWS_AT_ONCE", windows)
    draw = np.random.default_rng(12)
    passages = [words(draw, n) for n in (25, 40, 90)]
    texts = {}
    for i in range(60):
        text = words(draw, 3) + passages[i % 3] + words(draw, int(draw.integers(0, 9))) + passages[i % 2]
        at = int(draw.integers(len(text)))
        texts[i] = text[:at] + "#" + text[at + 1 :]
    assert found(spark, texts) == plain(texts)


def test_no_files_and_few_jobs(spark):
    """The repeated strings are written nowhere, kept nowhere, and read by few jobs however many
    partitions there are."""
    shared = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"))
    before, spark_context = set(shared.rglob("*")), spark.sparkContext
    draw = np.random.default_rng(13)
    passage = words(draw, 40)
    rows = [(i, words(draw, 5) + passage, "s") for i in range(40)]
    adaptive, kept = spark.conf.get("spark.sql.adaptive.enabled"), len(spark_context._jsc.getPersistentRDDs())
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark_context.setJobGroup("filters", "")
    try:
        result = repeats.repeat_spans(spark.createDataFrame(rows, SCHEMA))
        jobs = len(spark_context.statusTracker().getJobIdsForGroup("filters"))
        assert result.count() == 39
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
        spark_context.setLocalProperty("spark.jobGroup.id", None)
    assert jobs <= repeats.FILTER_PARTS + 3
    assert set(shared.rglob("*")) == before
    assert len(spark_context._jsc.getPersistentRDDs()) == kept


def test_texts_are_not_copied_out_of_a_batch():
    texts = ["é" * 40, "", "x", "a" * 5_000_000]
    tracemalloc.start()
    column = pa.array(texts, pa.string())
    got = repeats.encoded(column)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 1e6 and [bytes(raw) for raw in got] == [text.encode() for text in texts]
    for kind in (pa.string(), pa.large_string()):
        for part in (pa.array(texts, kind)[1:3], pa.array([""], kind), pa.array([], kind)):
            assert [bytes(raw) for raw in repeats.encoded(part)] == [t.encode() for t in part.to_pylist()]


def test_empty_table(spark):
    assert repeats.digest(spark.createDataFrame([], SCHEMA)).count() == 0


def test_long_texts_are_read_in_parts(monkeypatch):
    draw = np.random.default_rng(2)
    texts = [words(draw, n).encode() for n in (30, 3000, 5, 900, 40)] + [b""]
    whole = [np.concatenate(c) for c in zip(*repeats.anchors_of(texts), strict=True)]
    monkeypatch.setattr(repeats, "PART_BYTES", 1000)
    parts = [np.concatenate(c) for c in zip(*repeats.anchors_of(texts), strict=True)]
    assert sorted(zip(*whole, strict=True)) == sorted(zip(*parts, strict=True))


def test_intervals_hold_all_places():
    """Suffixes '', abc, abc, abcz, abd, x; ranks by place."""
    common, ranks = [-1, 0, 3, 3, 2, 0], [0, 5, 4, 2, 1, 3]
    got = [(d, low, high, best, sorted(l)) for d, low, high, best, l in repeats.intervals(common, ranks)]
    assert got == [(3, 1, 4, 3, [1, 2]), (2, 1, 5, 4, [3]), (0, 0, 6, 0, [4, 5])]
