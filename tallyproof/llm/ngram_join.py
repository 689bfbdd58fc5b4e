"""N-gram Jaccard join by universe-partition pigeonhole.

A document is the set of its distinct word n-grams. Sizes fall into bands; two sets whose Jaccard
similarity reaches the threshold lie in one band or in neighbouring bands and differ in at most
``H`` tokens, a number that only the band determines. A hash of the token deals every set of a band
into the same segments. Each segment gets weight 1 (indexed as it is) or weight 2 (indexed with its
one-deletion neighbourhood): two segments without a common key differ in at least that many tokens.
When the weights of a set exceed ``H``, any partner shares a key with it.

Segments too short to tell sets apart are not indexed, and their weight is subtracted. A set whose
remaining weight does not exceed ``H`` takes the next seed as well, until one suffices: of any pair,
both sets index every seed up to the first that suffices for one of them, so the pair is found.

Allocation by cost: an indexed segment of weight 1 costs one key, a neighbourhood one key per
token. Weight 1 is taken where enough segments of two or more tokens can be expected, weight 2 for
the small sets where they cannot.

Equal sets are one node from the start. Nodes and tokens are 64-bit hashes; links are verified by
exact set comparison of the whole texts.

Defined results: a null or empty text, or one of white space only, has no n-grams and is linked
with nothing; its component is its own id. A text with fewer words than ``n`` has one n-gram, its
whole sequence. Repeated rows, and rows with equal ids, are rows of their own; null ids are ignored
when the smallest id of a component is sought.
"""

from __future__ import annotations

import math
from collections import OrderedDict
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyproof.llm.common import blocks, fields, keeps_columns, mapped, row_id, stored, table, utf8, without
from tallyproof.llm.linking import linked, shared_buckets
from tallyproof.llm.words import BASE, mixed, windows, words

# Indexed segments of weight 1 have at least so many tokens.
LEAST = 2
# Standard deviations that the expected number of usable segments keeps above the need.
MARGIN = 1.5
# Chance of needing another seed is far below one half, so this is never reached.
SEEDS = 64


class Sets(NamedTuple):
    """Sorted distinct tokens of several rows, and the bounds of each row."""

    tokens: np.ndarray
    edges: np.ndarray


def shingles(data: np.ndarray, offsets: np.ndarray, n: int, lower: bool = True) -> Sets:
    """Distinct word n-grams of each row of a buffer."""
    rows = len(offsets) - 1
    w = words(data, offsets, lower)
    count = np.bincount(w.row, minlength=rows)
    size = max(0, len(w.hash) - n + 1)
    at = np.flatnonzero(w.row[:size] == w.row[n - 1 :]) if size else np.empty(0, np.int64)
    tokens, row = windows(w.hash, n)[at], w.row[at]
    few = np.flatnonzero((count > 0) & (count < n))
    if len(few):
        first = np.concatenate([[0], np.cumsum(count)])
        extra = [windows(w.hash[first[r] : first[r + 1]], int(count[r]))[0] ^ np.uint64(count[r]) for r in few]
        tokens, row = np.concatenate([tokens, np.array(extra, np.uint64)]), np.concatenate([row, few])
        order = np.argsort(row, kind="stable")
        tokens, row = tokens[order], row[order]
    edges = np.searchsorted(row, np.arange(rows + 1))
    tokens = tokens.copy()
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        tokens[a:b].sort()
    new = np.ones(len(tokens), bool)
    new[1:] = (tokens[1:] != tokens[:-1]) | (row[1:] != row[:-1])
    return Sets(tokens[new], np.searchsorted(row[new], np.arange(rows + 1)))


def signatures(sets: Sets) -> np.ndarray:
    """Order-free hash of each row's set."""
    with np.errstate(over="ignore"):
        total = np.concatenate([[np.uint64(0)], np.cumsum(mixed(sets.tokens ^ BASE), dtype=np.uint64)])
        size = np.diff(sets.edges).astype(np.uint64)
        return mixed((total[sets.edges[1:]] - total[sets.edges[:-1]]) + size * BASE).view(np.int64)


@lru_cache(64)
def band_edges(num: int, den: int, most: int) -> np.ndarray:
    """Smallest size of each band; a band reaches up to its smallest size over the threshold."""
    edges = [1]
    while edges[-1] <= most:
        edges.append(edges[-1] * den // num + 1)
    return np.array(edges)


class Plan(NamedTuple):
    segments: int
    weight: int
    most: int


@lru_cache(4096)
def allocation(num: int, den: int, low: int) -> Plan:
    """Segments and weight for the band that begins at size ``low``, and the largest difference H
    between two similar sets of which the smaller lies in it."""
    top = low * den // num
    most = (den - num) * (top + top * den // num) // (den + num)
    if most == 0:
        return Plan(1, 1, 0)
    for segments in range(most + 1, max(most + 2, low // LEAST + 1)):
        mean = low / segments
        usable = 1 - math.exp(-mean) * (1 + mean)
        if segments * usable - MARGIN * math.sqrt(segments * usable * (1 - usable)) >= most + 1 and mean >= 3:
            return Plan(segments, 1, most)
    # Every segment of the neighbourhood plan weighs 2; one is spare where the sets allow it.
    need = most // 2 + 1
    return Plan(need + (low // (need + 1) >= 8), 2, most)


def segment_sums(tokens: np.ndarray, group: np.ndarray, groups: int) -> tuple[np.ndarray, np.ndarray]:
    """Tokens and wrapped 64-bit sum of tokens per group; parts of 21 bits keep the sums exact."""
    count = np.bincount(group, minlength=groups)
    total, part = np.zeros(groups, np.uint64), np.uint64(0x1FFFFF)
    with np.errstate(over="ignore"):
        for shift in (0, 21, 42):
            piece = (tokens >> np.uint64(shift)) if shift == 42 else (tokens >> np.uint64(shift)) & part
            total += np.bincount(group, piece.astype(np.float64), groups).astype(np.uint64) << np.uint64(shift)
    return count, total


def index_keys(sets: Sets, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and key of every index entry of every row's set."""
    size = np.diff(sets.edges)
    edges = band_edges(num, den, int(size.max(initial=1)))
    own = np.searchsorted(edges, size, "right") - 1
    out_row, out_key = [], []
    for back in (0, 1):
        use = (size > 0) & (own - back >= 0)
        band = own - back
        plans = {int(b): allocation(num, den, int(edges[b])) for b in np.unique(band[use])}
        segments, weight, most = (
            np.array([getattr(plans[int(b)], f) if ok else 0 for b, ok in zip(band, use, strict=True)], np.int64)
            for f in ("segments", "weight", "most")
        )
        active = use
        for seed in range(SEEDS + 1):
            rows = np.flatnonzero(active)
            if not len(rows):
                break
            if seed == SEEDS:
                raise RuntimeError("no seed deals a set into enough segments")
            base = np.zeros(len(size), np.int64)
            base[rows] = np.concatenate([[0], np.cumsum(segments[rows])[:-1]])
            groups = int(segments[rows].sum())
            owner = np.repeat(rows, segments[rows])
            at = np.flatnonzero(np.repeat(active, size))
            row = np.repeat(np.arange(len(size)), size)[at]
            salt = mixed((band.astype(np.uint64) << np.uint64(8)) + np.uint64(seed + 1))
            token = mixed(sets.tokens[at] ^ salt[row])
            part = (token % segments[row].astype(np.uint64)).astype(np.int64)
            group = base[row] + part
            count, total = segment_sums(token, group, groups)
            place = salt[owner] + (np.arange(groups) - base[owner]).astype(np.uint64)
            with np.errstate(over="ignore"):
                place = mixed(place * BASE)
                light = weight[owner] == 1
                whole = light & (most[owner] == 0)
                shown = np.where(light, (count >= LEAST) | (whole & (count > 0)), count >= 1)
                kept = np.flatnonzero(shown)
                out_row.append(owner[kept])
                out_key.append(mixed(total[kept] + place[kept]))
                drop = np.flatnonzero((weight[row] == 2) & (count[group] >= 2))
                out_row.append(row[drop])
                out_key.append(mixed(total[group[drop]] - token[drop] + place[group[drop]]))
            lost = np.where(light, (count < LEAST) & ~whole, np.maximum(0, 2 - count))
            left = segments * weight - np.bincount(owner, lost, len(size))
            active = active & (left <= most)
    if not out_row:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(out_row), np.concatenate(out_key).view(np.int64)


def with_sets(docs: DataFrame, n: int, text: str) -> DataFrame:
    """``docs`` with n_shingles and sig (null for an empty set)."""
    chosen = docs.select(*without(docs, "n_shingles", "sig"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(batch.schema.get_field_index(text)))
            for i, j in blocks(offsets):
                sets = shingles(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], n)
                size = np.diff(sets.edges)
                more = [pa.array(size, pa.int64()), pa.array(signatures(sets), mask=size == 0)]
                columns = [*batch.slice(i, j - i).columns, *more]
                yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "n_shingles", "sig"])

    return mapped(chosen, work, f"{fields(chosen)}, n_shingles long, sig long")


def set_rows(docs: DataFrame, n: int, doc_id: str, text: str) -> DataFrame:
    """doc_id, row_id, n_shingles and sig of every row."""
    chosen = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), row_id(doc_id, text).alias("row_id"), F.col(f"`{text}`").alias("text"))
    return with_sets(chosen, n, "text").drop("text")


def key_rows(docs: DataFrame, n: int, num: int, den: int, text: str) -> DataFrame:
    """(key, node) of every set; a set that a task has met before is not indexed again."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            data, offsets = utf8(batch.column(0))
            for i, j in blocks(offsets):
                sets = shingles(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], n)
                sig = signatures(sets)
                fresh = []
                for r, s in enumerate(sig.tolist()):
                    if sets.edges[r] < sets.edges[r + 1] and s not in seen:
                        seen.add(s)
                        fresh.append(r)
                keep = np.zeros(len(sig), bool)
                keep[fresh] = True
                size = np.diff(sets.edges)
                chosen = Sets(sets.tokens[np.repeat(keep, size)], np.concatenate([[0], np.cumsum(np.where(keep, size, 0))]))
                row, key = index_keys(chosen, num, den)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(sig[row])], ["key", "node"])

    return mapped(docs.select(f"`{text}`"), work, "key long, node long")


def texts_of(docs: DataFrame, sets: DataFrame, nodes: DataFrame, n: int, doc_id: str, text: str) -> DataFrame:
    """(node, text) of one text of every node."""
    first = sets.join(nodes, sets.sig == nodes.node, "left_semi").groupBy("sig").agg(F.min("row_id").alias("own"))
    source = docs.select(row_id(doc_id, text).alias("row_id"), F.col(f"`{text}`").alias("text"))
    rows = source.join(first, F.col("row_id") == F.col("own")).select("sig", "text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # should two texts share a number, only the one with the wanted set stands for it
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for i, j in blocks(offsets):
                sig = signatures(shingles(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], n))
                part = batch.slice(i, j - i)
                right = pa.array(sig == part.column(0).to_numpy(zero_copy_only=False))
                yield part.filter(right).rename_columns(["node", "text"])

    return mapped(rows, work, "node long, text string").dropDuplicates(["node"])


def deltas(pairs: DataFrame, texts: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """``pairs`` (node, pivot) with size (of the node's set), good (similar to the pivot's set) and
    delta: the tokens of one but not the other, those outside the pivot first, each by value."""
    mine = texts.select("node", F.col("text").alias("mine"))
    hub = texts.select(F.col("node").alias("pivot"), F.col("text").alias("hub"))
    rows = pairs.join(mine, "node").join(hub, "pivot").select("node", "pivot", "mine", "hub").sortWithinPartitions("pivot")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hubs: OrderedDict[int, np.ndarray] = OrderedDict()

        def sets_of(column: pa.Array) -> list[np.ndarray]:
            data, offsets = utf8(column)
            found = shingles(data, offsets, n)
            return [found.tokens[x:y] for x, y in zip(found.edges[:-1], found.edges[1:], strict=True)]

        for whole in batches:
            for start in range(0, whole.num_rows, 128):
                batch = whole.slice(start, 128)
                pivots = batch.column(1).to_pylist()
                new = {p: k for k, p in enumerate(pivots) if p not in hubs}
                hubs.update(zip(new, (x.copy() for x in sets_of(batch.column(3).take(pa.array(list(new.values()), pa.int64())))), strict=True))
                size, good, delta = [], [], []
                for p, own in zip(pivots, sets_of(batch.column(2)), strict=True):
                    hub = hubs[p]
                    added, gone = np.setdiff1d(own, hub, assume_unique=True), np.setdiff1d(hub, own, assume_unique=True)
                    common = len(own) - len(added)
                    size.append(len(own))
                    good.append(den * common >= num * (len(own) + len(gone)))
                    delta.append(np.concatenate([added, gone]).view(np.int64))
                edge = np.concatenate([[0], np.cumsum([len(d) for d in delta])]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(edge), pa.array(np.concatenate(delta)))
                columns = [batch.column(0), batch.column(1), pa.array(size, pa.int64()), pa.array(good), lists]
                yield pa.RecordBatch.from_arrays(columns, ["node", "pivot", "size", "good", "delta"])
                for p in list(hubs)[:-64]:
                    del hubs[p]

    return mapped(rows, work, "node long, pivot long, size long, good boolean, delta array<long>")


def grouped(docs: DataFrame, n: int, num: int, den: int, doc_id: str, text: str) -> DataFrame:
    """doc_id, n_shingles, sig, root (one signature of the component) and component_id of every row;
    root is null for a row without n-grams."""
    sets = stored(set_rows(docs, n, doc_id, text), "sets")
    buckets = stored(shared_buckets(key_rows(docs, n, num, den, text)), "buckets")
    texts = stored(texts_of(docs, sets, buckets.select("node").distinct(), n, doc_id, text), "texts")
    groups = linked(buckets, lambda pairs: deltas(pairs, texts, n, num, den), num, den)
    first = sets.where("sig IS NOT NULL").groupBy("sig").agg(F.min("doc_id").alias("first"))
    placed = first.join(groups, first.sig == groups.node, "left")
    placed = placed.select("sig", F.coalesce("root", "sig").alias("root"), "first")
    smallest = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    named = placed.join(smallest, "root").select("sig", "root", "component_id")
    component = F.when(F.col("sig").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return sets.join(named, "sig", "left").select("doc_id", "n_shingles", "sig", "root", component.alias("component_id"))


def joined(
    docs: DataFrame, n: int = 4, num: int = 85, den: int = 100, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id, n_shingles, sig and component_id of every row of ``docs``."""
    return grouped(docs, n, num, den, doc_id, text).drop("root")


def op3_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    """Components of documents whose 4-word shingles have a Jaccard similarity of 0.85 or more."""
    return joined(table(spark, folder, "documents")).drop("sig")


@keeps_columns
def one_of_each(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Pipeline stage: one document of each component stays, the one of the smallest id.

    Rows with equal ids and equal sets are one document; equal or missing ids alone make none. Rows
    without n-grams stay as they are.
    """
    kept = grouped(docs, 4, 85, 100, "doc_id", "text").where("sig IS NOT NULL").groupBy("root")
    kept = kept.agg(F.min(F.struct(F.isnull("doc_id").alias("unnamed"), "doc_id", "sig")).alias("kept")).select("kept.doc_id", "kept.sig")
    rows = with_sets(docs, 4, "text")
    same = rows.sig.eqNullSafe(kept.sig) & rows.doc_id.eqNullSafe(kept.doc_id)
    stay = rows.where("sig IS NOT NULL").join(kept, same, "left_semi").dropDuplicates(["doc_id", "sig"])
    return stay.unionByName(rows.where("sig IS NULL")).select(*(f"`{c}`" for c in docs.columns))


ORACLE = """
WITH RECURSIVE docs AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
sets AS (
  SELECT DISTINCT rid, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS g FROM docs),
sizes AS (SELECT rid, count(*) AS n FROM sets GROUP BY rid),
common AS (
  SELECT a.rid AS x, b.rid AS y, count(*) AS c FROM sets a JOIN sets b ON a.g = b.g AND a.rid < b.rid GROUP BY ALL),
links AS (
  SELECT x, y FROM common JOIN sizes p ON p.rid = x JOIN sizes q ON q.rid = y WHERE 100 * c >= 85 * (p.n + q.n - c)),
edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (
  SELECT rid, rid AS other FROM docs UNION SELECT r.rid, e.y FROM reach r JOIN edges e ON e.x = r.other)
SELECT any_value(d.doc_id) AS doc_id, coalesce(any_value(n), 0) AS n_shingles, min(o.doc_id) AS component_id
FROM reach r JOIN docs d ON d.rid = r.rid JOIN docs o ON o.rid = r.other LEFT JOIN sizes s ON s.rid = r.rid
GROUP BY r.rid
"""
