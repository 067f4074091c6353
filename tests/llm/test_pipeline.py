"""Each stage of the pipeline against a plain version of it, on that stage's own input."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from meterlake.llm import packing, pii, quality
from meterlake.llm.common import stored
from test_documents import check_places, plain_components, plain_fingerprint, remaining_lines

SF_DIR = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Rows before the first and after every stage, written and read as the driver does."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    out = [docs]
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stage") / str(n))
        stage(spark, out[-1], SF_DIR).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def texts_of(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_columns(stages):
    assert [s.columns for s in stages[:5]] == [COLUMNS] * 5
    assert all(
        r.n_chars == len(r.text or "") for stage in stages[2:5:2] for r in stage.collect()
    )


def test_quality_stage(spark, stages):
    texts = texts_of(stages[0])
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    ranking = quality.fit(stages[0], labels)
    good = {
        i for i, text in texts.items()
        if ranking.scores(quality.feature_matrix([text or ""]))[0] >= quality.CUT_SCORE
    }
    assert texts_of(stages[1]) == {i: texts[i] for i in good}
    assert 0 < len(good) < len(texts)


def test_line_stage(stages):
    before = texts_of(stages[1])
    order = sorted(before)
    kept = remaining_lines([before[i] for i in order])
    assert texts_of(stages[2]) == {i: kept[n] for n, i in enumerate(order)}


def test_near_copy_stage(stages):
    before = texts_of(stages[2])
    prints = {i: plain_fingerprint(text) for i, text in before.items()}
    close = [(a, b) for a in prints for b in prints if (prints[a] ^ prints[b]).bit_count() <= 2]
    group = plain_components(prints, close)
    assert texts_of(stages[3]) == {i: before[i] for i in before if group[i] == i}


def test_surrogate_stage(stages):
    before, after = texts_of(stages[3]), texts_of(stages[4])
    assert before.keys() == after.keys()
    found = {r.doc_id: r.n_entities for r in pii.redact(stages[3]).collect()}
    assert {i for i in before if before[i] != after[i]} == {i for i, n in found.items() if n}
    assert not [i for i, text in after.items() if "@mail" in (text or "")]


def test_packing_stage(stages):
    rows = stages[5].collect()
    check_places(rows)
    encoding = packing.load_encoding()
    lengths = {
        i: len(encoding.encode_ordinary(text or "")) + 1 for i, text in texts_of(stages[4]).items()
    }
    placed = dict.fromkeys(lengths, 0)
    for row in rows:
        placed[row.doc_id] += row.length
    assert placed == lengths


AWKWARD = [
    (None, "no id", None, None, None), (1, None, None, None, None), (2, "", "en", "s", 0),
    (3, "same\nlines\nhere\nagain", "en", "s", 9), (4, "same\nlines\nhere\nagain", "en", "s", 9),
    (4, "same\nlines\nhere\nagain", "en", "s", 9), (5, "mail a@b.cc " * 3000, "en", None, 1),
    (6, "\n\n\n\n", "de", "s", 4), (7, "word " * 9000, "de", "s", 4), (8, "x", None, "s", 1),
]
CLASHING = ["n_lines", "n_removed", "n_entities", "bits", "id", "kind", "value", "line", "score"]


@pytest.mark.parametrize("rows", [AWKWARD, AWKWARD[:1], []])
def test_awkward_tables(spark, rows):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame(rows, schema).withColumns({n: F.lit("own") for n in CLASHING})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, SF_DIR), name.replace(" ", "-"))
        assert docs.columns == COLUMNS + CLASHING
        assert all(r[c] == "own" for r in docs.collect() for c in CLASHING)
    ids = {r.doc_id for r in docs.collect()}
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).collect()
    assert {r.doc_id for r in packed} == ids
    check_places(packed)


def test_run_is_all_stages(spark, stages):
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    whole = corpus_pipeline.run(spark, SF_DIR).select(*columns)
    assert sorted(whole.collect()) == sorted(stages[5].select(*columns).collect())
