"""The manifest against a plain recursive tree, odd rows, and proofs that must fail."""

from __future__ import annotations

import collections
import hashlib
import zlib

from helpers import SCHEMA, no_docs, odd_docs, odd_rows
from pyspark.sql import functions as F

from tallyproof.llm import merkle


def sha(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(row: tuple) -> str:
    doc_id, text, lang, source, n_chars = row
    values = [None if v is None else str(v) for v in (doc_id, source, lang, n_chars, text)]
    return sha(*["-" if v is None else f"{len(v.encode())}:{v}" for v in values])


def plain_tree(nodes: list[str]) -> tuple[str, list[list[tuple[str, str]]]]:
    """The last node, and the siblings before and after the way up from every node."""
    ways, above = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for way, place in zip(ways, above, strict=True):
            run = nodes[place // 3 * 3 : place // 3 * 3 + 3]
            way.append(("".join(run[: place % 3]), "".join(run[place % 3 + 1 :])))
        nodes = [sha(*nodes[i : i + 3]) for i in range(0, len(nodes), 3)]
        above = [place // 3 for place in above]
    return nodes[0], ways


def plain_manifest(rows: list[tuple]) -> list[tuple]:
    """doc_id, leaf, subroot, root, proof, folded root of a tampered copy, verified."""
    groups = collections.defaultdict(list)
    for r in rows:
        groups[b"" if r[3] is None else b"=" + r[3].encode()].append(r)
    trees, out = [], []
    for _, members in sorted(groups.items()):
        members.sort(key=lambda r: (r[0] is not None, r[0] or 0, plain_leaf(r)))
        trees.append((members, *plain_tree([plain_leaf(r) for r in members])))
    root, upper = plain_tree([t[1] for t in trees])
    for (members, subroot, ways), high in zip(trees, upper, strict=True):
        for r, way in zip(members, ways, strict=True):
            changed = r
            if r[0] is not None and r[1] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0:
                changed = (r[0], r[1].replace("\n", ""), *r[2:])
            node = plain_leaf(changed)
            for left, right in way + high:
                node = sha(left, node, right)
            proof = sha(*[a + b for a, b in way + high])
            out.append((r[0], plain_leaf(r), subroot, root, proof, node, node == root))
    return out


def queried(docs) -> collections.Counter:
    rows = merkle.manifest(docs, {"text": merkle.tampered(F.col("text"), F.col("doc_id"))})
    rows = rows.withColumn("folded", merkle.folded(F.col("other"), F.col("path")))
    found = rows.select("doc_id", "leaf", "subroot", "root", merkle.siblings_digest(F.col("path")), "folded", F.expr("folded = root"))
    return collections.Counter(tuple(r) for r in found.collect())


def many(counts: dict) -> list[tuple]:
    rows, i = [], 0
    for source, n in counts.items():
        for _ in range(n):
            i += 1
            rows.append((i * 7 % 100_003, f"text {i}\nline" if i % 3 else f"text {i}", "en", source, i))
    return rows


def test_manifest_equals_the_plain_tree(spark):
    # every count around a full run, below and above what one shuffle covers, and a hot source
    counts = {None: 5, "": 1, "a": 2, "b": 3, "c": 4, "d": 9, "e": 10, "f": 27, "hot": 900, "é": 243, "中": 244, "z": 1}
    rows = many(counts)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = queried(docs)
    assert got == collections.Counter(plain_manifest(rows))
    changed = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 2 == 0 and "\n" in r[1]]
    assert sum(v for k, v in got.items() if not k[-1]) == len(changed) > 0


def test_many_sources_and_one_source(spark):
    for rows in (many({f"s{i:04}": 1 + i % 2 for i in range(300)}), many({"only": 40}), many({"only": 1})):
        assert queried(spark.createDataFrame(rows, SCHEMA).repartition(3)) == collections.Counter(plain_manifest(rows))


def test_odd_repeated_and_no_rows(spark):
    docs = odd_docs(spark, ("tree", "idx", "digest", "path", "range", "root"))
    assert queried(docs) == collections.Counter(plain_manifest(odd_rows()))
    again = [odd_rows()[0]] * 400 + [(None, "x", None, None, None)] * 300
    assert queried(spark.createDataFrame(again, SCHEMA).repartition(4)) == collections.Counter(plain_manifest(again))
    assert merkle.manifest(no_docs(spark)).count() == 0


def test_levels_of_a_run_share_one_shuffle(spark):
    nodes = spark.createDataFrame([("t", i, 500, str(i)) for i in range(500)], "tree string, idx long, n long, digest string")
    plan = merkle.run_levels(nodes)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Sort [") == 1
