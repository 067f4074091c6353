"""Hard negatives against plain Python and SQL."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from compare import connect, difference

from meterlake.llm import hard_negatives
from meterlake.llm.queries import ORACLE_SQL, QUERIES

SF_DIR = "/root/testdata/sf0.01"
needs_tables = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")
SCHEMA = "vec_id long, embedding array<float>, label int, score string, id int, anchor double"


def plain_mine(rows, positives, negatives, step):
    known = []
    for vec_id, vector, label in rows:
        if vec_id is None or vector is None or label is None:
            continue
        if any(x is None or not math.isfinite(x) for x in vector):
            continue
        whole = [math.floor(256 * float(np.float32(x))) for x in vector]
        known.append((vec_id, whole, (label + 1) % 10 if vec_id % 7 == 0 else label))
    found = set()
    for anchor, vector, label in known:
        if anchor % step:
            continue
        own, other = set(), set()
        for vec_id, there, kind in known:
            if len(there) == len(vector) and (vec_id != anchor or kind != label):
                score = sum(x * y for x, y in zip(vector, there))
                (own if kind == label else other).add((-score, vec_id))
        for best, positive in sorted(own)[:positives]:
            fits = sorted((s, i) for s, i in other if 30 * -best <= 100 * -s <= 90 * -best)
            for rank, (score, negative) in enumerate(fits[:negatives], 1):
                found.add((anchor, positive, rank, negative, -best, -score))
    return Counter(found)


def mined(spark, rows, **settings):
    table = spark.createDataFrame([(i, v, n, "x", 1, 0.5) for i, v, n in rows], SCHEMA)
    return Counter(map(tuple, hard_negatives.mine(table, **settings).collect()))


def spread(seed, n, size, centres=0):
    draw = np.random.default_rng(seed)
    vectors = draw.normal(size=(n, size))
    if centres:
        vectors = draw.normal(size=(centres, size))[draw.integers(0, centres, n)] + 0.3 * vectors
    vectors = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    labels = draw.integers(0, 10, n)
    return [(i, v.astype(np.float32).tolist(), int(k)) for i, (v, k) in enumerate(zip(vectors, labels))]


@pytest.mark.parametrize(
    "seed, centres, settings",
    [(1, 0, {}), (2, 12, {}), (3, 12, {"round_components": 200}), (4, 3, {"positives": 1, "negatives": 40})],
)
def test_equals_plain_version(spark, monkeypatch, seed, centres, settings):
    """Short lists and steps, so that bounds decide; several rounds."""
    monkeypatch.setattr(hard_negatives, "STEP_ROWS", 8)
    rows = spread(seed, 700, 16, centres)
    k = settings.get("positives", 5), settings.get("negatives", 10)
    assert mined(spark, rows, anchor_step=20, **settings) == plain_mine(rows, *k, 20)


def test_awkward_rows(spark):
    """Null and odd vectors, sizes that differ, zero vectors, ties, copies, repeated ids."""
    rows = spread(5, 200, 8)
    vector, nan, inf = rows[3][1], float("nan"), float("inf")
    rows += [
        (None, vector, 1), (201, None, 1), (202, vector, None), (203, [None] + vector[1:], 1),
        (204, [nan] + vector[1:], 1), (205, [inf] + vector[1:], 1), (206, [-inf] + vector[1:], 1),
        (210, [0.0] * 8, 2), (300, [0.0] * 8, 2), (220, vector[:5], 3), (230, vector[:5], 3),
        (221, vector[:5], 4), (240, [], 1), (241, [], 1), (242, [], 2), (-40, vector, 3), (-14, vector, 9),
    ]
    rows += [(n, vector, n % 3) for n in range(1000, 1100)]  # one vector in a third of the rows
    rows += rows[:30]  # whole rows again
    rows += [(40, rows[50][1], 6), (40, rows[51][1], 7)]  # one id with several vectors
    assert mined(spark, rows, anchor_step=10) == plain_mine(rows, 5, 10, 10)


def test_too_long_vectors_take_no_part(spark):
    rows = spread(6, 60, 8)
    assert mined(spark, [*rows, (100, [1e30] * 8, 1), (200, [3e5] * 8, 1)], anchor_step=10) == mined(
        spark, rows, anchor_step=10
    )


def test_no_rows(spark):
    one = [(0, [1.0, 0.0], 1)]
    for rows in ([], one, [(1, [1.0], 1)], [*one, (1, [0.5, 0.5], 1)], [*one, (1, [0.5, 0.5], 2)]):
        assert not mined(spark, rows)


def test_bounds_hold_and_walks_end_early(monkeypatch):
    """No product is above its bound; members of narrow clusters leave most of the list."""
    rows = spread(7, 3000, 24, centres=40)
    vectors = np.floor(256 * np.array([v for _, v, _ in rows]))
    ids, labels = np.arange(len(rows)), np.zeros(len(rows), int)
    clusters = hard_negatives.clusters_of(ids[:100], ids[:100], labels[:100], vectors[:100])
    assert sum(len(c.ids) for c in clusters) == 100
    for cluster in clusters:
        most = cluster.lengths[:, None] * cluster.bounds(vectors)
        assert (cluster.vectors @ vectors.T <= most + 1e-6 * np.abs(most) + 1e-6).all()
    monkeypatch.setattr(hard_negatives, "STEP_ROWS", 50)
    products = 0
    for cluster in clusters:
        walk = hard_negatives.Walk(cluster, hard_negatives.OwnLabel(5, {}))
        walk.along(ids, labels, vectors)
        products += walk.products
        for member, goals in enumerate(walk.goals):
            scores = vectors @ cluster.vectors[member]
            scores[cluster.ids[member]] = -np.inf
            first = np.lexsort((ids, -scores))[:5]
            assert goals[0].ids.tolist() == first.tolist()
    assert products < 100 * len(rows) / 2


@needs_tables
def test_query_equals_sql(spark):
    rows = QUERIES["op11_hard_negatives"](spark, SF_DIR)
    assert difference(rows, connect(SF_DIR), ORACLE_SQL["op11_hard_negatives"]) == ""
