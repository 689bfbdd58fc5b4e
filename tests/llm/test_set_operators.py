"""Joins, searches, dedup, packing, mixing and lists against brute force on small inputs."""

from __future__ import annotations

import collections
import itertools
import random
import zlib
from datetime import date

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from compare import connect, rows_of
from helpers import FOLDER, STORY, WORD, documents, no_docs, odd_docs, odd_rows

from tallyproof.llm import components, mixing, ngram_join, passages, registry, sharding, url_filter, vptree


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_equals_its_twin(spark, name):
    df = registry.QUERIES[name](spark, FOLDER)
    cursor = connect(FOLDER).execute(registry.ORACLES[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(columns, cursor.fetchall())


def shingle_sets(texts: list[str | None], n: int = 4) -> list[frozenset]:
    out = []
    for text in texts:
        words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        grams = [tuple(words[i : i + n]) for i in range(len(words) - n + 1)]
        out.append(frozenset(grams or ([tuple(words)] if words else [])))
    return out


def brute_components(ids: list, texts: list) -> dict:
    sets, parent = shingle_sets(texts), list(range(len(ids)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(range(len(ids)), 2):
        common = len(sets[i] & sets[j])
        if sets[i] and sets[j] and 100 * common >= 85 * len(sets[i] | sets[j]):
            parent[max(root(i), root(j))] = min(root(i), root(j))
    least = {}
    for i, doc in enumerate(ids):
        if doc is not None:
            least[root(i)] = min(doc, least.get(root(i), doc))
    return collections.Counter((doc, len(sets[i]), least.get(root(i)) if sets[i] else doc) for i, doc in enumerate(ids))


def near_copies() -> list[tuple]:
    """Chains of edits of texts of all small sizes and some large ones, at and around the threshold."""
    chance, out = random.Random(9), []
    for size in [*range(1, 48, 2), 90, 200, 600]:
        words = [f"w{chance.randint(0, 10**6)}" for _ in range(size)]
        for _ in range(6):
            out.append(" ".join(words))
            for _ in range(max(1, size // 90)):
                words[chance.randrange(size)] = f"w{chance.randint(0, 10**6)}"
    return [(i, t) for i, t in enumerate(out)]


def test_join_equals_brute_force(spark):
    for rows in (documents(), near_copies()):
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
        got = collections.Counter(tuple(r) for r in ngram_join.joined(docs).drop("sig").collect())
        assert got == brute_components([r[0] for r in rows], [r[1] for r in rows])


def test_join_of_odd_rows(spark):
    docs = odd_docs(spark, ("sig", "node", "component_id", "key"))
    got = collections.Counter(tuple(r) for r in ngram_join.joined(docs).drop("sig").collect())
    assert got == brute_components([r[0] for r in odd_rows()], [r[1] for r in odd_rows()])
    assert ngram_join.joined(no_docs(spark)).count() == 0
    stay = ngram_join.one_of_each(spark, docs, "").collect()
    assert sum(r["text"] == STORY for r in stay) == 1
    assert sum(not WORD.search(r["text"] or "") for r in stay) == sum(not WORD.search(r[1] or "") for r in odd_rows())


def test_every_similar_pair_shares_a_key():
    chance = random.Random(4)
    for size in [*range(1, 60), 100, 300, 1000]:
        base = [chance.getrandbits(64) for _ in range(size)]
        cut = chance.randint(0, size)
        for drop in range(size):
            other = base[drop:] + [chance.getrandbits(64) for _ in range(cut)]
            common = size - drop
            if 100 * common < 85 * (size + len(other) - common):
                continue
            both = [np.array(sorted(x), np.uint64) for x in (base, other)]
            sets = ngram_join.Sets(np.concatenate(both), np.array([0, len(base), len(base) + len(other)]))
            row, key = ngram_join.index_keys(sets, 85, 100)
            assert set(key[row == 0].tolist()) & set(key[row == 1].tolist()), (size, drop, cut)


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, i) for i in range(1001, 1100)] + [(5000, 5000), (7001, 7000), (7000, 7001)]
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {i: 0 for i in range(61)} | {i: 1000 for i in range(1000, 1100)} | {7000: 7000, 7001: 7000}
    assert got == want


def test_nearest_equal_brute_force(spark):
    chance = np.random.default_rng(3)
    vectors = np.concatenate([chance.normal(size=(700, 8)), np.ones((60, 8)), chance.normal(size=(40, 8)).round()])
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    odd = [(900, None), (901, []), (902, [0.0] * 8), (903, [1.0, None] * 4), (904, [float("nan")] + [1.0] * 7), (905, [float("inf")] * 8), (None, [1.0] * 8), rows[3], (906, [1.0, 2.0])]
    frame = spark.createDataFrame([(*r, "x") for r in rows + odd], "vec_id long, embedding array<double>, shard string")
    used = vptree.candidates(frame)
    trees, shards = vptree.indexed(used, shard_rows=150)
    assert shards > 1
    asked = used.where("id % 7 = 0")
    got = collections.defaultdict(list)
    for r in vptree.nearest(trees, shards, asked, k=10, relax=1.0, block_rows=40).collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    for q in range(0, 800, 7):
        gap = sorted((float(np.sqrt(((vectors[q] - v) ** 2).sum())), i) for i, v in enumerate(vectors) if i != q)[:10]
        assert [(r, v) for r, v, _ in sorted(got[q])] == [(k + 1, i) for k, (_, i) in enumerate(gap)]
        assert [s for *_, s in sorted(got[q])] == pytest.approx([g for g, _ in gap], abs=1e-12)
    assert set(got) == set(range(0, 800, 7))
    none = used.limit(0)
    trees, shards = vptree.indexed(none)
    assert vptree.nearest(trees, shards, none).count() == 0


def test_recall_of_the_registered_search(spark):
    import duckdb

    rows = duckdb.sql(f"SELECT vec_id, embedding FROM '{FOLDER}/embeddings.parquet' ORDER BY 1").fetchall()
    ids, vectors = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], np.float64)
    got = collections.defaultdict(set)
    for r in vptree.op2_vptree(spark, FOLDER).collect():
        got[r["query_id"]].add(r["vec_id"])
    hits = []
    for q in ids[ids % 100 == 0]:
        gap = np.sqrt(((vectors - vectors[ids == q]) ** 2).sum(1))
        order = [i for i in ids[np.lexsort((ids, gap))] if i != q][:10]
        hits.append(len(got[q] & set(order)) / 10)
    assert np.mean(hits) >= 0.9


def test_planted_passages_are_found_and_clean_documents_left_alone(spark):
    chance = random.Random(2)
    word = lambda: f"w{chance.randint(0, 10**9)}"
    text = lambda n: [word() for _ in range(n)]
    shared, near = text(51), text(80)
    rows = [(i, " ".join(text(200))) for i in range(30)]
    for i in range(30, 40):
        lead = text(chance.randint(0, 80))
        rows.append((i, " ".join(lead) + "\n" * (i % 2) + " " + " ".join(shared) + " " + " ".join(text(chance.randint(0, 80)))))
    for i in range(40, 44):
        edited = [w if k % 40 != i % 40 else word() for k, w in enumerate(near)]
        rows.append((i, " ".join([*text(20), *edited, *text(30)])))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = passages.repeats(docs)
    got = found.collect()
    assert {r["doc_id"] for r in got} == set(range(30, 44))
    assert {r["doc_id"] for r in got if r["doc_id"] < 40 and r["removed"]} == set(range(31, 40))
    texts = dict(rows)
    for r in got:
        if r["doc_id"] < 40:
            assert texts[r["doc_id"]][r["start"] : r["end"]].split()[0] in shared
    clean = {r["doc_id"]: r["text"] for r in passages.cleaned(docs, found).collect()}
    assert len(clean) == len(rows) and all(clean[i] == texts[i] for i in range(30))
    assert all(len(clean[i]) < len(texts[i]) for i in range(31, 40))


def test_passages_of_odd_rows(spark):
    docs = odd_docs(spark, ("start", "sig", "removed", "node"))
    got = passages.repeats(docs).collect()
    assert {r["doc_id"] for r in got} >= {0, 1, 7, 8} and not {2, 3, 4, 5, 6, 9} & {r["doc_id"] for r in got}
    assert passages.repeats(no_docs(spark)).count() == 0


def test_sharding_laws(spark):
    for docs, want in ((odd_docs(spark, ("shard", "slot", "group", "item")), len(odd_rows())), (spark.createDataFrame(documents(), "doc_id long, text string"), 200)):
        rows = sharding.sharded(docs).collect()
        assert len(rows) == want
        slots = collections.defaultdict(list)
        for r in rows:
            slots[r["shard"]].append(r["slot"])
            assert 0 <= r["shard"] < 16
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    texts = dict(documents())
    load = collections.Counter()
    for r in rows:
        raw = texts[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"]) == (len(raw) + 1, zlib.crc32(raw))
        load[r["shard"]] += r["size"]
    assert max(load.values()) - min(load.values()) <= 0.02 * max(load.values())
    assert sharding.sharded(no_docs(spark)).count() == 0


def test_a_group_with_a_third_of_all_rows_is_split(spark):
    rows = [(i, "same text here" if i % 3 == 0 else f"text {i} of its own") for i in range(3000)]
    shards = collections.Counter(r["shard"] for r in sharding.sharded(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert len(shards) == 16 and max(shards.values()) - min(shards.values()) <= 40


def test_a_large_group_of_equal_rows_is_split(spark):
    rows = [(None, "same text here")] * 1000 + [(5, "other text here")] * 1000 + [(i, f"text {i} of its own") for i in range(1000)]
    out = sharding.sharded(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    shards = collections.Counter(r["shard"] for r in out)
    assert len(shards) == 16 and max(shards.values()) - min(shards.values()) <= 20
    assert collections.Counter(r["doc_id"] for r in out) == collections.Counter(r[0] for r in rows)
    for shard, n in shards.items():
        assert sorted(r["slot"] for r in out if r["shard"] == shard) == list(range(n))


def test_packing_follows_the_dot_product():
    chance = random.Random(4)
    items = [[chance.randint(1, 9000), chance.randint(0, 900), chance.randint(1, 9)] for _ in range(400)]
    totals = [sum(i[m] for i in items) for m in range(3)]
    left = [[1.0] * 3 for _ in range(7)]
    want = {}
    for n in sorted(range(400), key=lambda n: -max(items[n][m] * 7 / totals[m] for m in range(3))):
        need = [items[n][m] * 7 / totals[m] for m in range(3)]
        fits = [sum(a * b for a, b in zip(room, need, strict=True)) for room in left]
        want[n] = fits.index(max(fits))
        left[want[n]] = [a - b for a, b in zip(left[want[n]], need, strict=True)]
    got = sharding.packed(sharding.shares(np.array(items, float), 7), 7)
    assert [want[n] for n in range(400)] == got.tolist()


def test_parcels_balance_bytes_tokens_and_rows(spark):
    """Many small groups of three shapes, in parcels a quarter as many to a shard as in production."""
    shape = lambda i: ("x" * 900 + str(i), f"{i} " + "a " * 300, str(i))[i % 3]
    texts = {i: shape(i) for i in range(9000)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    loads = collections.defaultdict(lambda: np.zeros(3))
    for r in sharding.sharded(docs, parcels=1000).collect():
        loads[r["shard"]] += (r["size"], len(WORD.findall(texts[r["doc_id"]])), 1)
    spread = np.array(list(loads.values()))
    assert len(loads) == 16
    wide = (spread.max(0) - spread.min(0)) / spread.mean(0)
    assert wide[0] <= 0.02 and wide.max() <= 0.2, wide


def test_mixing_meets_its_targets(spark):
    rows = [(i, "abcdefghi", "en", "src0" if i % 3 == 0 else f"src{i % 20 + 20}", 9) for i in range(6000)]
    docs = spark.createDataFrame(rows, odd_docs(spark).schema)
    out = mixing.replicated(docs, {"src0": 10.0}).collect()
    assert abs(len(out) - 6000) < 400
    sources = {r[3] for r in rows}
    assert sum(r["source"] == "src0" for r in out) / len(out) == pytest.approx(10 / (9 + len(sources)), abs=0.03)
    assert [tuple(r) for r in out] == [tuple(r) for r in mixing.replicated(docs.repartition(7), {"src0": 10.0}).collect()] or sorted(map(tuple, out)) == sorted(
        map(tuple, mixing.replicated(docs.repartition(7), {"src0": 10.0}).collect())
    )


def test_mixing_of_odd_rows(spark):
    docs = odd_docs(spark, ("copy", "key", "doc", "Shuffle_Key", "cdf"))
    out = mixing.replicated(docs, {"s0": 0.0}, budget=3.0)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "key", "doc", "cdf", "copy", "shuffle_key"]
    rows = out.collect()
    assert rows and all(r["source"] != "s0" for r in rows)
    assert mixing.replicated(no_docs(spark)).count() == 0
    with pytest.raises(ValueError, match="negative"):
        mixing.replicated(docs, {"s0": -1.0})


def test_every_row_draws_by_itself(spark):
    """A third of all rows are equal, a third have no id; the twin draws the same."""
    rows = [(7, "one text", "en", "src0", 8)] * 2000 + [(None, f"text {i}", "en", "src1", 8) for i in range(2000)]
    rows += [(i, "short", "en", None, 5) for i in range(2000)] + odd_rows()
    docs = spark.createDataFrame(rows, odd_docs(spark).schema)
    out = [tuple(r) for r in mixing.replicated(docs.repartition(5)).collect()]
    sizes, weights = collections.Counter(), {"src0": 4.0, "src1": 2.0}
    for r in rows:
        sizes[r[3]] += len((r[1] or "").encode()) + 1
    for source in ("src0", "src1"):
        rate = sum(sizes.values()) * weights[source] / ((6 + len(sizes) - 2) * sizes[source])
        copies = sum(r[3] == source for r in out)
        assert copies == pytest.approx(2000 * rate, rel=0.1), source
    con = duckdb.connect()
    con.register("documents", pa.Table.from_pylist([dict(zip(docs.columns, r, strict=True)) for r in rows]))
    assert sorted(map(str, out)) == sorted(map(str, con.sql(mixing.ORACLE).fetchall()))
    assert sorted(map(str, out)) == sorted(str(tuple(r)) for r in mixing.replicated(docs.coalesce(1)).collect())


def test_poisson_draws_of_large_means(spark):
    rows = [(i, "a", "en", "big" if i < 500 else "x", 1) for i in range(600)]
    out = mixing.replicated(spark.createDataFrame(rows, odd_docs(spark).schema), {"big": 1.0}, 0.0, budget=2000 / 1.2)
    count = collections.Counter(r["doc_id"] for r in out.select("doc_id").collect())
    draws = np.array([count[i] for i in range(500)])
    assert draws.mean() == pytest.approx(2000, rel=0.01) and draws.var() == pytest.approx(2000, rel=0.3)


def test_lists_by_date(spark):
    entries = spark.createDataFrame(
        [
            ("Bad.example.com", date(2024, 1, 10), "add", "block"), ("bad.example.com", date(2024, 1, 20), "remove", "block"),
            ("bad.example.com", date(2024, 2, 1), "add", "block"), ("example.com", date(2024, 1, 1), "add", "allow"),
            ("org", date(2024, 1, 5), "add", "block"), ("org", date(2024, 1, 5), "remove", "block"),
            (None, date(2024, 1, 1), "add", "block"), ("net", None, "add", "block"), ("net", date(2024, 1, 1), "burn", "block"),
        ],
        "domain string, listed date, action string, list string",
    )
    cases = [
        ("http://bad.example.com/x", date(2024, 1, 9), False, "example.com"), ("http://bad.example.com/x", date(2024, 1, 10), True, "bad.example.com"),
        ("HTTPS://u:p@A.BAD.example.com.:8080?q", date(2024, 1, 19), True, "bad.example.com"), ("http://bad.example.com", date(2024, 1, 20), False, "example.com"),
        ("http://notbad.example.com", date(2024, 1, 15), False, "example.com"), ("http://bad.example.com", date(2025, 1, 1), True, "bad.example.com"),
        ("http://x.org", date(2024, 1, 6), False, None), ("nonsense", date(2024, 1, 6), False, None), (None, date(2024, 1, 6), False, None),
        ("", None, False, None), ("http://x.net/", date(2024, 3, 1), False, None), ("http://bad.example.com/x", date(2024, 1, 10), True, "bad.example.com"),
    ]
    captures = spark.createDataFrame([(i, u, d, "taken", "taken") for i, (u, d, *_) in enumerate(cases)], "page_id long, url string, fetched date, blocked string, day string")
    got = {r["page_id"]: (r["blocked"], r["matched_domain"]) for r in url_filter.judged(captures, entries).collect()}
    assert got == {i: (b, m) for i, (_, _, b, m) in enumerate(cases)}
    assert url_filter.judged(captures.limit(0), entries).count() == 0
    assert not any(r["blocked"] for r in url_filter.judged(captures, entries.limit(0)).collect())
