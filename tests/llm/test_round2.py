"""Skewed corpora in the mixing stage."""

import logging

import pytest

import corpus_pipeline
from ratewise.llm import mixing, quality
from tests.llm.test_documents import SCHEMA


def corpus(spark, tiny):
    rows = [(i, "w " * (20 + i % 30), ("en", "en", "en", "de")[i % 4], ("a", "a", "b")[i % 3], 0) for i in range(1200)]
    return spark.createDataFrame(rows + [(9000 + i, "w " * 50, lang, source, 0) for i, (lang, source) in enumerate(tiny)], SCHEMA)


@pytest.mark.parametrize("tiny", [[], [("en", "own")], [("xx", "a")], [("xx", "own")]])
def test_one_tiny_cell_does_not_set_the_sample_size(spark, tiny):
    docs = corpus(spark, tiny)
    ids = {r.doc_id for r in corpus_pipeline.source_mixing(spark, docs, "").collect()}
    rows = mixing.mix(docs, sweeps=None, keep=mixing.KEEP).collect()
    everything = sum(r.tokens for r in rows)
    assert sum(r.tokens * r.p for r in rows) == pytest.approx(mixing.KEEP * everything, rel=1e-6)
    assert sum(r.tokens for r in rows if r.sampled) == pytest.approx(mixing.KEEP * everything, rel=0.1)
    assert ids == {r.doc_id for r in rows if r.sampled} and all(0 < r.p <= 1 for r in rows)
    # cells that are not kept whole stand in the raked proportions
    assert len({round(r.p / r.factor, 9) for r in rows if r.p < 1}) == 1
    assert all(r.p == 1 for r in rows if r.doc_id >= 9000)


def test_a_residual_that_cannot_go_is_measured_and_reported(spark, caplog):
    with caplog.at_level(logging.INFO, mixing.__name__):
        mixing.mix(corpus(spark, []), sweeps=None, keep=0.5).count()
        assert [r.levelname for r in caplog.records] == ["INFO"]
        caplog.clear()
        mixing.mix(corpus(spark, [("xx", "own")]), sweeps=None, keep=0.5).count()
        assert [r.levelname for r in caplog.records] == ["WARNING"] and "source" in caplog.text


def test_quality_is_fitted_on_the_documents_its_figures_are_for():
    assert quality.FIT_DOCS == 10_000
