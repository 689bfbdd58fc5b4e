"""Quality rules, BPE, personal data and the quality model against plain versions of their contracts."""

from __future__ import annotations

import collections
import hashlib
import random
import re
import struct
import zlib

import numpy as np
import pyarrow as pa
import pytest
from helpers import FOLDER, STORY, WORD, documents, no_docs, odd_docs, odd_rows

from tallyproof.llm import bpe, pii, quality_model, quality_rules, tagger
from tallyproof.llm.common import table, utf8
from tallyproof.llm.words import BASE, byte_values


def plain_measures(text: str) -> tuple:
    """Counts and shares as their definitions read, by Python strings."""
    words = WORD.findall(text)
    spots = [m.start() for m in WORD.finditer(text)]
    assert len(spots) == len(words)
    chars = sum(map(len, words))

    def repeated(n):
        grams = [tuple(words[i : i + n]) for i in range(len(words) - n + 1)]
        count = collections.Counter(grams)
        marked = {j for i, g in enumerate(grams) if count[g] > 1 for j in range(i, i + n)}
        top = max([0, *(c * sum(map(len, g)) for g, c in count.items() if c > 1)])
        return marked, top

    seen, lines, line_chars = set(), 0, 0
    for line in text.split("\n"):
        if WORD.search(line):
            if line in seen:
                lines += 1
                line_chars += sum(map(len, WORD.findall(line)))
            seen.add(line)
    share = lambda x: x / chars if chars else 0.0
    marked = {n: repeated(n) for n in range(2, 11)}
    return (
        len(words), chars, len(re.findall(r"[#*$%&|<>]", text)), lines, len(marked[3][0]), share(line_chars),
        *(share(marked[n][1]) for n in quality_rules.TOP),
        *(share(sum(len(words[j]) for j in marked[n][0])) for n in quality_rules.ALL),
    )


def test_measures_equal_their_definitions():
    texts = [t for _, t in documents()[:80]] + ["", " \n ", "a a a a a", "x\ny z\nx\nx\n\n \n", STORY + "\n" + STORY, "é è é è é è"]
    data, offsets = utf8(__import__("pyarrow").array(texts))
    got = quality_rules.measure_block(data, offsets)
    for i, text in enumerate(texts):
        mine = tuple(got[c][i] for c in [*quality_rules.COUNTS, *quality_rules.SHARES])
        assert mine == pytest.approx(plain_measures(text)), text[:80]


def test_rules_on_odd_rows(spark):
    rows = quality_rules.judged(odd_docs(spark, ("kept", "N_words", "base_failed"))).collect()
    assert len(rows) == len(odd_rows())
    for r in rows:
        assert r["n_words"] == len(WORD.findall(r["text"] or ""))
        assert not (r["base_failed"] and r["kept"])
        if r["n_words"] < 50:
            assert r["base_failed"]
    assert quality_rules.judged(no_docs(spark)).count() == 0


def test_rules_keep_labelled_good_documents(spark):
    folder = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r["quality"] for r in table(spark, folder, "labels").collect()}
    got = [r for r in quality_rules.op4_quality_rules(spark, folder).collect() if not r["base_failed"]]
    good = [r["kept"] for r in got if labels.get(r["doc_id"]) == 1]
    bad = [r["kept"] for r in got if labels.get(r["doc_id"]) == 0]
    assert sum(good) >= 0.99 * len(good) and sum(bad) <= 0.1 * len(bad)


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(bpe.vocabulary())


def wanted(library, text: str) -> tuple:
    ids = library.encode(text, add_special_tokens=False).ids
    back = library.decode(ids, skip_special_tokens=False)
    packed = struct.pack(f"<{len(ids)}I", *ids)
    return len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(back.encode()).hexdigest()


def test_encoding_equals_the_library(spark, library):
    got = {r["doc_id"]: tuple(r)[1:] for r in bpe.op9_bpe(spark, FOLDER).collect()}
    for doc_id, text in documents():
        assert got[doc_id] == wanted(library, text)


def test_encoding_of_odd_rows(spark, library):
    out = bpe.encoded(odd_docs(spark, ("ids", "Decoded")), bpe.vocabulary())
    assert "taken" not in [r["decoded"] for r in out.select("decoded").collect()]
    rows = bpe.digests(out, "text").collect()
    assert len(rows) == len(odd_rows())
    for r in rows:
        assert tuple(r)[1:] == wanted(library, r["text"] or "")
    assert bpe.encoded(no_docs(spark), bpe.vocabulary()).count() == 0


def test_repaired_runs_equal_the_library(library):
    encoder = bpe.Encoder.of(open(bpe.vocabulary(), encoding="utf-8").read())
    chance = random.Random(5)
    parts = ["abcdefghij", "'s", "'ll", "'re", "<|endoftext|>", "0123", "!?-", "é", "é", "中文字", " ", " ", "İ", "ﬁ", "'", "<|", "|>", "Σς"]
    for size in (10, 500, 4000):
        for _ in range(25):
            text = "".join(chance.choice(chance.choice(parts)) if chance.random() < 0.6 else chance.choice(parts) for _ in range(size))
            assert encoder.run(text) == library.encode(text, add_special_tokens=False).ids


def test_a_small_memory_changes_nothing(library):
    encoder = bpe.Encoder(open(bpe.vocabulary(), encoding="utf-8").read())
    encoder.words, encoder.chunks = bpe.Memory(3), bpe.Memory(2)
    for _, text in documents()[:40]:
        raw = np.frombuffer(text.encode(), np.uint8)
        ids, _ = encoder.encode(raw, np.array([0, len(raw)]))
        assert np.frombuffer(ids[0], "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


PATTERNS = [
    re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    re.compile(r"[0-9]([\x20-]?[0-9])+"),
    re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def literal_spans(text: str) -> list:
    out = []
    for kind, pattern in enumerate(PATTERNS):
        for m in pattern.finditer(text):
            digits = re.sub("[^0-9]", "", m[0])
            good = (
                True,
                kind == 1 and all(int(x) <= 255 for x in m[0].split(".")),
                14 <= len(digits) <= 19 and pii.luhn(digits),
                10 <= len(digits) <= 15,
            )[kind]
            if good:
                out.append(pii.Span(m.start(), kind, m.end()))
    return sorted(out)


def test_base_spans_equal_the_literal_patterns():
    chance = random.Random(3)
    parts = ["a", "b@", "c.d", "@", ".", "1", "22", "3.4", "+", "-", " ", "(", ")", "555", "4465758382889437", "x@y.z", "4.4.4.4", "+1 23"]
    texts = ["".join(chance.choice(parts) for _ in range(chance.randint(1, 14))) for _ in range(8000)]
    for text in texts + [t for _, t in documents()]:
        assert pii.base_spans(text) == literal_spans(text)


def test_long_runs_take_linear_time():
    text = "a" * 300_000 + " 1" + "1" * 300_000 + " x@y.zz " + "+" * 100_000
    assert [s.kind for s in pii.base_spans(text)] == [0]


def test_gradients_equal_differences():
    model = {k: v.astype(np.float64) for k, v in tagger.initial(1).items()}
    x = np.random.default_rng(0).integers(0, tagger.CLASSES, (3, 7)).astype(np.uint8)
    y = np.array([[0, 1, 2, 2, 0, 3, 4], [0] * 7, [7, 8, 0, 5, 6, 6, 0]])
    grads = tagger.loss_and_grads(model, x, y)[1]
    for name, grad in grads.items():
        at = tuple(np.unravel_index(np.abs(grad).argmax(), grad.shape))
        model[name][at] += 1e-3
        more = tagger.loss_and_grads(model, x, y)[0]
        model[name][at] -= 2e-3
        less = tagger.loss_and_grads(model, x, y)[0]
        model[name][at] += 1e-3
        assert (more - less) / 2e-3 == pytest.approx(float(grad[at]), rel=1e-2, abs=1e-3)


@pytest.fixture(scope="module")
def model(spark):
    return pii.fitted(table(spark, "/root/testdata/sf0.01", "documents"))


def test_tagger_finds_held_out_forms(model):
    for kind in range(4):
        chance, hits = random.Random(50 + kind), 0
        for _ in range(100):
            body = pii.rewritten(kind, chance).removeprefix("tel:")
            text = f"Thnt that oratin th {body} he of th. And so on the"
            spans = pii.found_spans([text], model)[0][1]
            hits += any(s.start <= 20 and s.end >= 20 + len(body) for s in spans)
        assert hits >= 75, (pii.KINDS[kind], hits)


def test_base_spans_stay_and_clean_texts_stay_clean(model):
    texts = [t for _, t in documents("/root/testdata/sf0.01")]
    for text, (base, spans) in zip(texts, pii.found_spans(texts, model), strict=True):
        assert base == pii.base_spans(text) and set(base) <= set(spans)
        if not any(c in text for c in "@0123456789"):
            assert not spans
    assert sum(len(s) - len(b) for b, s in pii.found_spans(texts, model)) <= 0.1 * sum(len(pii.base_spans(t)) for t in texts) + 2


def test_spans_do_not_depend_on_the_place_in_the_text(model):
    body = "call (743) 555-3824 now"
    for lead in (0, 50, 63, 64, 65, 120, 127, 1000, 100_000):
        spans = pii.found_spans(["a " * (lead // 2) + body + " and more " * 20], model)[0][1]
        assert [(s.kind, s.start - lead // 2 * 2, s.end - s.start) for s in spans] == [(3, 5, 14)], lead


def test_personal_data_of_odd_rows(spark, model):
    docs = odd_docs(spark, ("spans", "base", "n_email"))
    rows = pii.searched(docs, model).collect()
    assert len(rows) == len(odd_rows()) and all(r["base"] == "" for r in rows)
    assert pii.searched(no_docs(spark), model).count() == 0
    line = [(1, "write to a.b@c.de or +1 (743) 555-3824, not 1.2", "en", "s", 9)]
    out = pii.searched(spark.createDataFrame(line, odd_docs(spark).schema), model, redact=True).first()
    assert out["text"] == "write to [EMAIL] or [PHONE], not 1.2"
    assert out["base"] == "email:9:17,phone:21:38" and out["n_phone"] == 1


def plain_features(text: str) -> collections.Counter:
    """Buckets of words, pairs and character n-grams inside words, by a loop over strings and whole numbers."""
    last = 2**64 - 1
    byte = [int(v) for v in byte_values()]

    def mix(x: int) -> int:
        x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & last
        x = (x ^ x >> 27) * 0x94D049BB133111EB & last
        return x ^ x >> 31

    def spot(x: int, kind: int) -> int:
        return mix(x + kind * int(BASE) & last) % quality_model.BUCKETS

    def char(c: str) -> int:
        code = c.encode()
        return byte[code[0]] if len(code) == 1 else mix(int.from_bytes(code, "big") * int(BASE) & last)

    found, whole = collections.Counter(), []
    for word in WORD.findall(text):
        code = word.encode()
        whole.append(mix(sum(byte[b] * pow(int(BASE), k, 2**64) for k, b in enumerate(code)) + len(code) * int(BASE) & last))
        found[spot(whole[-1], 1)] += 1
        signs = [int(quality_model.LEFT), *map(char, word), int(quality_model.RIGHT)]
        for n in quality_model.GRAMS:
            for i in range(len(signs) - n + 1):
                value = 0
                for sign in signs[i : i + n]:
                    value = (value * int(BASE) + sign) & last
                found[spot(mix(value), n)] += 1
    for a, b in zip(whole, whole[1:], strict=False):
        found[spot(b - a & last, 2)] += 1
    return found


def test_quality_features_equal_a_loop_over_strings():
    texts = ["", " \n\t ", "a", "ab cd ab cd", "naïve Größe 東京 タワー 🙂🙂 x🙂y", "é", "end é", "a\u00a0b\u2003c", STORY, "x" * 5000]
    texts += [t or "" for _, t in documents()]
    data, offsets = utf8(pa.array(texts, pa.string()))
    found = [collections.Counter() for _ in texts]
    for row, place in quality_model.features(data, offsets):
        for r, p in zip(row.tolist(), place.tolist(), strict=True):
            found[r][p] += 1
    assert found == [plain_features(t) for t in texts]


def test_quality_model_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.1"
    labels = {r["doc_id"]: r["quality"] for r in table(spark, folder, "labels").collect()}
    rows = quality_model.op5_subword_quality(spark, folder).collect()
    assert len(rows) == 10_000
    tested = [r for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    assert sum(r["predicted"] == labels[r["doc_id"]] for r in tested) >= 0.97 * len(tested)


def test_quality_model_on_odd_rows(spark):
    docs = odd_docs(spark, ("score", "places", "quality"))
    labels = spark.createDataFrame([(0, 1), (10, 0), (10, 0), (None, 1), (7, None), (1, 1)], "doc_id long, quality int")
    rows = quality_model.scored(docs, quality_model.fitted(docs, labels)).collect()
    assert len(rows) == len(odd_rows()) and all(0 <= r["score"] <= 1 for r in rows)
    assert len({r["score"] for r in rows if not r["text"]}) == 1
    none = quality_model.fitted(docs, labels.limit(0))
    assert {r["score"] for r in quality_model.scored(docs, none).collect()} == {0.5}
    assert quality_model.scored(no_docs(spark), none).count() == 0
