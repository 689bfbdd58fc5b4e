"""Integer product quantization against a plain loop, odd vectors and large sums."""

from __future__ import annotations

import collections

import numpy as np
import pytest
from helpers import FOLDER

from tallyproof.llm import vector_codes
from tallyproof.llm.common import table

SCHEMA = "vec_id long, embedding array<float>, label int, ints string, code string"


def plain_codes(rows: list[tuple]) -> tuple[list[tuple], list]:
    """Codes and errors by Python integers, and the codebooks."""
    good = [r for r in rows if r[1] is not None and all(x is not None and np.isfinite(x) for x in r[1])]
    ints = [(r[0], [int(np.floor(float(np.float32(x)) * 1024)) for x in r[1]], r[2]) for r in good]
    ints.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not ints:
        return [], []
    ints = [r for r in ints if len(r[1]) == len(ints[0][1])]
    width = len(ints[0][1]) // 4
    cut = [[r[1][p * width : (p + 1) * width] for p in range(4)] for r in ints]
    books = [[list(c[p]) for c in cut[:256]] for p in range(4)]

    def nearest(part, book):
        best = min((sum((a - b) ** 2 for a, b in zip(part, e, strict=True)), i) for i, e in enumerate(book))
        return best[1], best[0]

    for _ in range(4):
        for p in range(4):
            members = collections.defaultdict(list)
            for c in cut:
                members[nearest(c[p], books[p])[0]].append(c[p])
            for e, own in members.items():
                books[p][e] = [sum(v) // len(own) for v in zip(*own, strict=True)]
    out = []
    for r, c in zip(ints, cut, strict=True):
        found = [nearest(c[p], books[p]) for p in range(4)]
        out.append((r[0], r[2], "".join(f"{i:02x}" for i, _ in found), sum(d for _, d in found)))
    return out, books


def made(spark, rows: list[tuple]):
    return spark.createDataFrame([(*r, "taken", "taken") for r in rows], SCHEMA).repartition(4)


def agree(spark, rows: list[tuple]) -> None:
    want, books = plain_codes(rows)
    got, own = vector_codes.compressed(made(spark, rows))
    assert collections.Counter(tuple(r) for r in got.select("vec_id", "label", "code", "error").collect()) == collections.Counter(want)
    assert own.tolist() == books or not books


def test_codes_equal_a_plain_loop(spark):
    chance = np.random.default_rng(1)
    rows = [(i * 3, [float(x) for x in v], int(i % 5)) for i, v in enumerate(chance.normal(size=(600, 8)))]
    agree(spark, rows)
    # ties everywhere: few values, many equal vectors, negative sums
    tied = [(i, [float(x) for x in v], None) for i, v in enumerate(chance.integers(-3, 2, (500, 4)) / 1024)]
    agree(spark, tied)


def test_odd_vectors(spark):
    chance = np.random.default_rng(2)
    rows = [(i, [float(x) for x in v], i % 2 or None) for i, v in enumerate(chance.normal(size=(40, 8)))]
    rows += [(100, None, 1), (101, [None] * 8, 1), (102, [float("nan")] * 8, 1), (103, [float("inf")] + [0.0] * 7, 1), (104, [0.0] * 8, 1)]
    rows += [rows[3], (5, [0.5] * 8, 2), (None, [0.25] * 8, 3), (105, [1.0, 2.0], 1), (106, [], 1), (107, [-0.0] * 8, None)]
    agree(spark, rows)
    assert vector_codes.compressed(made(spark, []))[0].count() == 0
    assert vector_codes.compressed(made(spark, [(1, None, 1)]))[0].count() == 0


def test_what_is_refused(spark):
    with pytest.raises(ValueError):
        vector_codes.compressed(made(spark, [(1, [1.0] * 6, 1)]))
    with pytest.raises(Exception, match="not below"):
        vector_codes.compressed(made(spark, [(1, [3e4] * 8, 1)]))


def test_distances_by_dictionaries_equal_differences():
    chance = np.random.default_rng(3)
    for spread in (2, 1000, 2**24):
        rows, books = chance.integers(-spread, spread, (300, 12)), chance.integers(-spread, spread, (4, 50, 3))
        codes, error = vector_codes.assigned(rows, books)
        apart = ((rows.reshape(300, 4, 1, 3) - books[None]) ** 2).sum(-1)
        assert (codes == apart.argmin(-1)).all() and (error == apart.min(-1).sum(-1)).all()


def test_labels_beyond_the_broadcast_bound(spark, monkeypatch):
    want = {tuple(r) for r in vector_codes.op13_vector_codes(spark, FOLDER).collect()}
    monkeypatch.setattr(vector_codes, "sized_side", lambda side: (side, False))
    assert {tuple(r) for r in vector_codes.op13_vector_codes(spark, FOLDER).collect()} == want
    sums = collections.Counter()
    labels = {r["vec_id"]: r["label"] for r in table(spark, FOLDER, "embeddings").collect()}
    for r in want:
        sums[labels[r[0]]] += r[2]
    assert all(r[3] == sums[labels[r[0]]] for r in want)
