"""Cases in which an operator once did less than the whole job."""

from __future__ import annotations

import random

import pytest

from tallyproof.llm import ngram_join, passages, pii
from tallyproof.llm.common import table


@pytest.fixture(scope="module")
def model(spark):
    return pii.fitted(table(spark, "/root/testdata/sf0.01", "documents"))


def test_rows_without_an_id_or_with_one_id_are_documents_of_their_own(spark):
    text = lambda name: " ".join(f"{name}{i}" for i in range(30))
    rows = [(None, text("a")), (None, text("b")), (None, text("b")), (7, text("c")), (7, text("d")), (8, text("d")), (None, text("e")), (9, text("e"))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    stay = [tuple(r) for r in ngram_join.one_of_each(spark, docs, "").collect()]
    assert sorted(stay, key=str) == sorted([(None, text("a")), (None, text("b")), (7, text("c")), (7, text("d")), (9, text("e"))], key=str)


def test_spelled_out_addresses_without_a_digit_are_found(model):
    for body in ("john.doe [at] example [dot] com", "anna (at) mail (dot) org", "kim_lee [AT] server [DOT] net", "r.muster[at]firma.de"):
        text = f"Thnt that oratin th {body} he of th. And so on the"
        (span,) = pii.found_spans([text], model)[0][1]
        assert span.kind == 0 and 14 <= span.start <= 20 and 20 + len(body) <= span.end <= 24 + len(body), body
    chance, hits = random.Random(77), 0
    word = lambda: "".join(chance.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(chance.randint(3, 9)))
    for _ in range(100):
        at, dot = chance.choice([(" [at] ", " [dot] "), (" (at) ", " (dot) "), ("[at]", "."), (" (at) ", ".")])
        body = f"{word()}{chance.choice(['', '.' + word()])}{at}{word()}{dot}{chance.choice(['com', 'org', 'net'])}"
        text = f"{'and more ' * 30}write to {body} he of th. And so on the"
        spans = pii.found_spans([text], model)[0][1]
        hits += any(s.start <= 279 and s.end >= 279 + len(body) for s in spans)
    assert hits >= 75, hits


def test_addresses_in_bare_words_are_found_and_plain_words_are_not(model):
    chance, hits = random.Random(7), 0
    word = lambda: "".join(chance.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(chance.randint(3, 9)))
    for _ in range(100):
        case = chance.choice([str, str, str.upper])
        local = word() + chance.choice(["", "." + word(), case(" dot ") + word()])
        body = f"{local}{case(' at ')}{word()}{case(' dot ')}{chance.choice(['com', 'org', 'net'])}"
        spans = pii.found_spans([f"{'and more ' * 30}write to {body} he of th. And so on the"], model)[0][1]
        hits += any(s.start == 279 and s.end == 279 + len(body) for s in spans)
    assert hits >= 85, hits
    clean = [
        "the train stops at noon and the dot on the map shows where we stood at the time",
        "they looked at the dot com boom of that decade and at the people in it",
        "put a dot at the end of each line , then a dot at the start",
        "connect dot to dot and look at what appears",
        "he was at home and they dot the field at night",
    ]
    assert not any(spans for _, spans in pii.found_spans(clean, model))


LONG_ADDRESS = "maximilian.alexander.von.und.zu.musterhausen [at] department.of.public.affairs [dot] university.of.somewhere [dot] example [dot] com"


def test_a_long_span_is_found_at_every_place(model):
    assert len(LONG_ADDRESS) > pii.WINDOW
    shapes = set()
    for lead in range(0, 2 * pii.STRIDE):
        text = "x" * lead + " note " + LONG_ADDRESS + " and so on" * 30
        shapes.add(tuple((s.kind, s.start - lead, s.end - lead) for s in pii.found_spans([text], model)[0][1]))
    hit = [s for shape in shapes for s in shape if s[0] == 0 and s[1] <= 6 and s[2] >= 6 + len(LONG_ADDRESS)]
    assert len(hit) == len(shapes), shapes


def test_runs_that_no_window_holds_end_in_bounded_work(model):
    text = "12 34-56 " * 20_000 + "mail a.b@c.de " + "9" * 30_000
    base, spans = pii.found_spans([text], model)[0]
    assert set(base) <= set(spans) and any(s.kind == 0 for s in base)
    assert all(s.end - s.start <= pii.LONGEST for s in set(spans) - set(base))


def words_of(chance, n):
    return [f"w{chance.randint(0, 10**9)}" for _ in range(n)]


def test_a_copied_passage_is_removed_whole(spark):
    chance = random.Random(5)
    rows, rest = [], {}
    for k in range(12):
        shared = words_of(chance, 51)
        for i in range(3):
            lead, tail = (words_of(chance, chance.choice([0, 3, 20, 70])) for _ in "ab")
            rows.append((10 * k + i, " ".join([*lead, *shared, *tail])))
            rest[10 * k + i] = [*lead, *(shared if i == 0 else []), *tail]
    # a short copy in the first document does not hide the longer one of the others
    long = words_of(chance, 90)
    rest |= {900: [*words_of(chance, 30), *long[20:60]], 901: [*words_of(chance, 30), *long], 902: words_of(chance, 25)}
    rows += [(900, " ".join(rest[900])), (901, " ".join(rest[901])), (902, " ".join([*rest[902], *long]))]
    rest[901] = [*rest[901][:50], *rest[901][90:]]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = passages.runs(docs)
    clean = {r["doc_id"]: r["text"].split() for r in passages.cleaned(docs, found).collect()}
    assert clean == rest


def test_edited_copies_are_found(spark):
    chance = random.Random(6)
    rows, rest = [], {}
    for k in range(0, 40, 4):
        passage, long = words_of(chance, 60), words_of(chance, 600)
        edited, longer = [*passage], [*long]
        edited[30], longer[300] = words_of(chance, 2)
        rest |= {k: passage, k + 1: [], k + 2: long, k + 3: []}
        rows += [(k, " ".join(passage)), (k + 1, " ".join(edited)), (k + 2, " ".join(long)), (k + 3, " ".join(longer))]
    # a passage that is no paragraph by itself: all but the edited word goes
    passage = words_of(chance, 60)
    for k in range(100, 110):
        lead, tail, edited = words_of(chance, k % 7 * 9), words_of(chance, k % 5 * 20), [*passage]
        edited[30] = words_of(chance, 1)[0] if k > 100 else passage[30]
        rows.append((k, " ".join([*lead, *edited, *tail])))
        rest[k] = [*lead, *(edited if k == 100 else edited[30:31]), *tail]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = passages.repeats(docs)
    clean = {r["doc_id"]: r["text"].split() for r in passages.cleaned(docs, found).collect()}
    whole = [k for k in range(0, 40, 4) for k in (k + 1, k + 3)]
    assert all(clean[k] == rest[k] for k in clean if k not in whole)
    # a cut moves with the edit in few long texts, bands miss one in a hundred
    assert sum(clean[k] == [] for k in whole) >= len(whole) - 2
    assert all(len(clean[k]) <= 1 for k in whole)


def test_rows_of_one_id_keep_their_own_texts(spark):
    chance = random.Random(8)
    shared, own, other = words_of(chance, 60), words_of(chance, 100), words_of(chance, 40)
    rows = [(1, shared), (7, own), (7, [*other, *shared]), (8, own[:30])]
    docs = spark.createDataFrame([(i, " ".join(t), "mine") for i, t in rows], "doc_id long, text string, row_id string")
    found = passages.repeats(docs)
    out = passages.cleaned(docs, found)
    assert out.columns == docs.columns and {r["row_id"] for r in out.collect()} == {"mine"}
    clean = sorted((r["doc_id"], r["text"].split()) for r in out.collect())
    assert clean == sorted([(1, shared), (7, own), (7, other), (8, [])])


def test_rows_without_an_id_are_documents_after_all_others(spark):
    chance = random.Random(9)
    shared, alone = words_of(chance, 60), words_of(chance, 60)
    tails = [words_of(chance, 20) for _ in range(5)]
    rows = [(None, [*shared, *tails[0]]), (None, [*shared, *tails[1]]), (3, [*shared, *tails[2]])]
    rows += [(None, [*alone, *tails[3]]), (None, [*alone, *tails[4]]), (None, [*alone, *tails[4]])]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in rows], "doc_id long, text string").repartition(3)
    clean = [r["text"].split() for r in passages.cleaned(docs, passages.repeats(docs)).collect()]
    assert sorted(map(tuple, clean)).count(tuple(rows[2][1])) == 1
    assert {tuple(c) for c in clean} >= {tuple(tails[0]), tuple(tails[1])}
    # of the rows without an id one text keeps the passage, its copy included
    whole = [c for c in clean if c[:60] == alone]
    assert len({tuple(c) for c in whole}) == 1


def test_many_rows_without_an_id_take_linear_work(spark):
    chance = random.Random(10)
    base = words_of(chance, 120)
    rows = []
    for i in range(3000):
        edited = [*base]
        edited[i % 120] = f"e{i}"
        rows.append((None if i % 3 else 5, " ".join(edited)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    sets = ngram_join.set_rows(docs, 4, "doc_id", "text")
    texts = ngram_join.texts_of(docs, sets, sets.select(sets.sig.alias("node")).distinct(), 4, "doc_id", "text")
    assert texts.count() == 3000
    assert ngram_join.one_of_each(spark, docs, "").count() == 1
    found = passages.occurrences(docs, "doc_id", "text")
    cut = passages.texts_of(docs, found, found.select(found.sig.alias("node")).distinct(), "doc_id", "text")
    assert cut.count() == found.select("sig").distinct().count()


def test_nearly_all_similar_paragraphs_meet(spark):
    """Recall of the bands against all pairs of paragraphs of the smallest table and of edited ones."""
    chance, rows = random.Random(12), []
    docs = table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text").collect()
    rows = [(r["doc_id"], r["text"]) for r in docs]
    for k, (_, text) in enumerate(rows[:60]):
        words = (text or "").split()
        for spot in range(chance.randint(5, 40), len(words), 90):
            words[spot] = f"edit{spot}"
        rows.append((10_000 + k, " ".join(words)))
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = passages.occurrences(frame, "doc_id", "text")
    texts = passages.texts_of(frame, found, found.select(found.sig.alias("node")).distinct(), "doc_id", "text").collect()

    def grams(text):
        words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text).split()
        return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}

    sets = {r["node"]: grams(r["text"]) for r in texts}
    holders = {}
    for node, own in sets.items():
        for g in own:
            holders.setdefault(g, []).append(node)
    pairs = {(a, b) for nodes in holders.values() if len(nodes) < 200 for a in nodes for b in nodes if a < b}
    similar = {(a, b) for a, b in pairs if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])}
    keys = {}
    for r in passages.key_rows(frame, "text").collect():
        keys.setdefault(r["node"], set()).add(r["key"])
    met = sum(bool(keys[a] & keys[b]) for a, b in similar)
    assert len(similar) >= 50 and met >= 0.95 * len(similar), (met, len(similar))


def test_copies_are_released_when_their_results_are_stored(spark):
    from pathlib import Path

    from tallyproof.session import shared_folder

    docs = table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text")
    before = set(Path(shared_folder(spark)).iterdir())
    passages.repeats(docs)
    left = [p.name for p in set(Path(shared_folder(spark)).iterdir()) - before]
    assert sorted(n.rsplit("-", 1)[0] for n in left) == ["tallyproof-runs", "tallyproof-similar"]
