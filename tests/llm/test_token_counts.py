"""Counts of the compiled transducer against the library."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
from helpers import FOLDER, documents, no_docs, odd_docs, odd_rows

from tallyproof.llm import token_counts
from tallyproof.llm.common import blocks, utf8


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=token_counts.vocabulary())


@pytest.fixture()
def machine():
    with open(token_counts.vocabulary(), "rb") as file:
        return token_counts.Machine.of(file.read())


def counts(machine, texts: list[str], size: int = 1 << 19) -> list[int]:
    data, offsets = utf8(pa.array(texts, pa.string()))
    out = []
    for i, j in blocks(offsets, size):
        points, cuts = token_counts.marked(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], machine.vocabulary.lead)
        out.append(machine.counts(points, cuts))
    return np.concatenate(out).tolist()


def strange_texts() -> list[str]:
    chance = random.Random(11)
    parts = [" ", "  ", "\n", "\t", "▁", "a", "the", "ing", "é", "é", "ﬁ", "中文", "😀", "\x00", "0", "12", "-", "==", "<s>", "</s>", "<unk>", "<0x41>", "internationalization", "　", "﻿", "Ω"]
    out = ["", " ", "  ", "▁", "a", " a", "a ", "x" * 50_000, "ab" * 20_000, " " * 30_000, "-" * 9_999, "=" * 5_001, "中" * 4_000, "\n" * 3_000, "aaaa" * 999]
    for size in (1, 2, 3, 5, 20, 200, 3000):
        for _ in range(60):
            few = chance.sample(parts, chance.randint(1, 6))
            out.append("".join(chance.choice(few) for _ in range(size)))
    return out


def test_counts_equal_the_library(machine, library):
    texts = strange_texts() + [t for _, t in documents()]
    assert counts(machine, texts) == [len(x) for x in library.encode(texts)]


def test_chunks_and_blocks_of_any_size(machine, library, monkeypatch):
    texts = strange_texts()[::3]
    want = [len(x) for x in library.encode(texts)]
    for chunk, block in ((1, 1 << 19), (2, 100), (7, 1 << 12), (1000, 1)):
        monkeypatch.setattr(token_counts, "CHUNK", chunk)
        short = [t if chunk > 2 else t[:400] for t in texts]
        assert counts(machine, short, block) == (want if chunk > 2 else [len(x) for x in library.encode(short)])


def test_emptied_tables_change_nothing(machine, library, monkeypatch):
    monkeypatch.setattr(token_counts, "MOST", 500)
    texts = [t for _, t in documents()[:60]]
    assert counts(machine, texts, 4096) == [len(x) for x in library.encode(texts)]
    assert machine.used < 100_000


def test_emissions_are_never_taken_back(machine):
    counts(machine, [t for _, t in documents()[:60]])
    cells = machine.cells[machine.cells[:, 0] >= 0]
    assert (cells[:, 1] >> token_counts.STATE_BITS >= 0).all() and (machine.owed >= 0).all()


def test_other_models_are_refused(library):
    from sentencepiece import sentencepiece_model_pb2 as proto

    spec = proto.ModelProto()
    spec.ParseFromString(library.serialized_model_proto())
    spec.normalizer_spec.remove_extra_whitespaces = True
    with pytest.raises(ValueError):
        token_counts.Vocabulary(spec.SerializeToString())


def test_query_and_odd_rows(spark, library):
    texts = dict(documents())
    for r in token_counts.op12_token_counts(spark, FOLDER).collect():
        n = len(library.encode(texts[r["doc_id"]]))
        assert tuple(r)[1:] == (len(texts[r["doc_id"]].encode()), n, n > 4096)
    out = token_counts.counted(odd_docs(spark, ("N_tokens", "over_limit", "points")), token_counts.vocabulary())
    rows = out.collect()
    assert len(rows) == len(odd_rows()) and {r["points"] for r in rows} == {"taken"}
    for r in rows:
        n = len(library.encode(r["text"] or ""))
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len((r["text"] or "").encode()), n, n > 4096)
    assert token_counts.counted(no_docs(spark), token_counts.vocabulary()).count() == 0
