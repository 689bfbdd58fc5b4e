"""The pipeline's stages one by one against plain versions, and as a whole."""

from __future__ import annotations

import collections

import pytest
from helpers import FOLDER, documents, no_docs, odd_docs, odd_rows
from test_set_operators import brute_components

import corpus_pipeline
from tallyproof.llm import bpe, mixing, pii, quality_rules
from tallyproof.llm.common import stored, table


@pytest.fixture(scope="module")
def outputs(spark):
    docs, out = table(spark, FOLDER, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, FOLDER), "test-stage")
        out.append(docs)
    return out


def test_columns_of_the_stages(spark, outputs):
    columns = table(spark, FOLDER, "documents").columns
    assert [o.columns for o in outputs[:-1]] == [columns] * 4
    assert len(corpus_pipeline.STAGES) == 5


def test_quality_stage_drops_what_the_rules_reject(spark, outputs):
    kept = {r["doc_id"] for r in quality_rules.op4_quality_rules(spark, FOLDER).collect() if r["kept"]}
    assert {tuple(r) for r in outputs[0].select("doc_id", "text").collect()} == {d for d in documents() if d[0] in kept}


def test_join_stage_keeps_one_document_of_each_group(outputs):
    rows = [tuple(r) for r in outputs[0].select("doc_id", "text").collect()]
    groups = brute_components([r[0] for r in rows], [r[1] for r in rows])
    assert sorted(r["doc_id"] for r in outputs[1].select("doc_id").collect()) == sorted({c for _, _, c in groups})


def test_personal_data_stage_replaces_every_base_span(outputs):
    before = dict(map(tuple, outputs[1].select("doc_id", "text").collect()))
    after = outputs[2].collect()
    assert len(after) == len(before)
    for r in after:
        assert r["n_chars"] == len(r["text"])
        if not any(c in before[r["doc_id"]] for c in "@0123456789"):
            assert r["text"] == before[r["doc_id"]]
        assert not pii.base_spans(r["text"])


def test_mixing_and_encoding_stages(spark, outputs):
    want = collections.Counter(r["doc_id"] for r in mixing.replicated(outputs[2]).collect())
    assert collections.Counter(r["doc_id"] for r in outputs[3].collect()) == want
    tokens = collections.Counter(r["doc_id"] for r in outputs[4].collect())
    assert tokens == want
    assert bpe.encode_stage(spark, no_docs(spark), FOLDER).count() == 0


def test_run_is_the_stages_in_turn(spark, outputs):
    got = collections.Counter(tuple(r) for r in corpus_pipeline.run(spark, FOLDER).collect())
    assert got == collections.Counter(tuple(r) for r in outputs[-1].collect())


def test_stages_take_odd_rows_and_empty_tables(spark):
    for docs in (odd_docs(spark), no_docs(spark)):
        for _, stage in corpus_pipeline.STAGES:
            docs = stored(stage(spark, docs, FOLDER), "test-odd")
        docs.count()


def test_stages_hand_on_columns_of_any_name(spark):
    extra = ("sig", "N_words", "copy", "base", "kept", "row_id", "key", "shuffle_key", "spans", "doc", "ids")
    docs = odd_docs(spark, extra)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, FOLDER)
        assert out.columns == docs.columns
        rows = out.collect()
        assert rows and all(r[c] == "taken" for r in rows for c in extra)
        assert {r["doc_id"] for r in rows} <= {r[0] for r in odd_rows()}
    empty = no_docs(spark)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, empty, FOLDER).columns == empty.columns
