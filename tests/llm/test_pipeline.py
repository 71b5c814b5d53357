"""The pipeline's stages on whole small tables."""
from collections import Counter

import corpus_pipeline
import pytest
from test_jaccard import brute, shingles

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def run(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES:
        out.append((docs, docs := stage(spark, docs, SF).cache()))
    return out


def test_stages_hand_on_the_columns(run):
    for before, after in run[:-1]:
        assert after.columns == before.columns and after.count() > 0
    assert run[-1][1].columns == [*run[-1][0].columns, "ids"]


def test_filters_keep_whole_rows(run):
    for before, after in run[:3]:
        assert not Counter(map(tuple, after.collect())) - Counter(map(tuple, before.collect()))


def test_one_of_each_group_stays(run):
    before, after = run[2]
    want = {c for _, n, c in brute([(r.doc_id, r.text) for r in before.collect()]) if n}
    assert {r.doc_id for r in after.collect() if shingles(r.text)} == want


def test_run_is_the_stages_in_turn(spark, run):
    got = Counter((r.doc_id, r.text, tuple(r.ids)) for r in corpus_pipeline.run(spark, SF).collect())
    assert got == Counter((r.doc_id, r.text, tuple(r.ids)) for r in run[-1][1].collect())


def test_stages_take_empty_and_odd_tables(spark, docs, no_docs):
    for frame in (docs, no_docs):
        for _, stage in corpus_pipeline.STAGES:
            out = stage(spark, frame, SF)
            assert out.columns[:len(frame.columns)] == frame.columns
            out.count()
