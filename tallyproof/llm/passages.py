"""Substring dedup by paragraph MinHash banding, and by pieces for exact runs of any place.

Exact runs (``runs``): every text is cut into pieces at the places where the hash of two neighbouring
words is the least of 14 around it; each runs to the next place, so every word is in one, but no piece
is shorter than 16 words. Any run of 29 words that two documents share holds a whole piece, cut alike
in both. Equal pieces are extended word by word to the ends of the run, against all documents at once.

Similar paragraphs (``similar_paragraphs``) are cut by content, not by lines, at the places where the
hash of two neighbouring words is the least within 48 before and behind it: paragraphs of 49 words and
more, about 97 on average, and every text of fewer words as a whole. Five-word shingles of each are
MinHashed into 4 bands of 2 rows: similarity 0.8 collides with probability 0.98, equality always.
Colliding paragraphs are verified by their exact Jaccard similarity and linked into components; of each
component that occurs in several documents the occurrences in the document of the smallest id stay and
the others are removed, edited words included.

A similarity of 0.8 leaves at most one edit in 45 words, so an edited passage that is no paragraph of
its own still holds runs of 29 words, which are found as such; the edited words between them stay.

Defined results: null and empty texts, and texts of fewer than 16 words, have no paragraphs. Letters
A to Z are folded. Repeated rows are occurrences like any other; rows with equal ids count as one
document, and spans are cut from the row they were found in. Every row without an id is a document of
its own, after all that have one; of such rows, those of equal text are one.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyproof.llm.common import blocks, fields, mapped, row_id, stored, table, utf8
from tallyproof.llm.linking import linked, shared_buckets
from tallyproof.llm.ngram_join import deltas
from tallyproof.llm.words import BASE, code_points, mixed, sums, windows, words
from tallyproof.operators.sides import sized_side
from tallyproof.session import stored_copies

# Paragraphs are cut at the least word pair within so many on both sides; shorter texts have none.
AROUND, LENGTH = 48, 16
SHINGLE, BANDS, BAND_ROWS = 5, 4, 2
NUM, DEN = 80, 100
# Pieces are cut at the least of so many word pairs and have at least so many words. A common run of
# 2 * PIECE_WINDOW + 1 words holds a whole piece, and reaches less than REACH words beyond its pieces.
PIECE_WINDOW, PIECE_LENGTH, REACH = 14, 16, 16
# Signatures a task remembers so as not to index a copy twice; forgetting them costs rows only.
REMEMBERED = 500_000


class Paragraphs(NamedTuple):
    row: np.ndarray
    first: np.ndarray
    last: np.ndarray
    sig: np.ndarray


def sliding(values: np.ndarray, n: int, pick: np.ufunc) -> np.ndarray:
    """``pick`` over every ``n`` consecutive values, in log2(n) passes."""
    out, width = values, 1
    while width < n:
        step = min(width, n - width)
        out = pick(out[: len(out) - step], out[step:])
        width += step
    return out


def places(pairs: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
    """Positions whose value is the least of some ``n`` consecutive ones of their row."""
    if len(pairs) < n:
        return np.empty(0, np.int64)
    least = sliding(pairs, n, np.minimum)
    least = np.where(row[: len(least)] == row[n - 1 : n - 1 + len(least)], least, 0)
    wide = np.concatenate([np.zeros(n - 1, np.uint64), least, np.zeros(n - 1, np.uint64)])
    chosen = (sliding(wide, n, np.maximum) == pairs) & (pairs > 0)
    chosen[1:] &= pairs[1:] != pairs[:-1]
    return np.flatnonzero(chosen)


def pieces(hashes: np.ndarray, row: np.ndarray) -> Paragraphs:
    """Pieces of the rows of a buffer: each runs to the next place, or over it to its least length.
    Every word is in one, but for the last words of a row when they are too few."""
    n = len(hashes)
    none = np.empty(0, np.int64)
    if not n:
        return Paragraphs(none, none, none, none)
    inside = np.flatnonzero(row[:-1] == row[1:])
    cut = inside[places(windows(hashes, 2)[inside], row[inside], PIECE_WINDOW)]
    head = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
    first = np.unique(np.concatenate([cut, head]))
    row_end = np.append(head[1:], n)[np.searchsorted(head, first, "right") - 1]
    last = np.maximum(np.append(first[1:], n), first + PIECE_LENGTH)
    first, last = first[last <= row_end], last[last <= row_end]
    return Paragraphs(row[first], first, last, sums(hashes)(first, last).view(np.int64))


def paragraphs(hashes: np.ndarray, row: np.ndarray) -> Paragraphs:
    """Paragraphs of the rows of a buffer, given its words: they cover every word of a row."""
    n = len(hashes)
    none = np.empty(0, np.int64)
    if not n:
        return Paragraphs(none, none, none, none)
    inside = np.flatnonzero(row[:-1] == row[1:])
    pairs, pair_row, size = windows(hashes, 2)[inside], row[inside], 2 * AROUND + 1
    head = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
    first = head
    if len(pairs) >= size:
        left = sliding(pairs, AROUND, np.minimum)[: len(pairs) - size + 1]
        right = sliding(pairs, AROUND + 1, np.minimum)[AROUND:]
        whole = pair_row[: len(pairs) - size + 1] == pair_row[size - 1 :]
        at = np.flatnonzero(whole & (right == pairs[AROUND : AROUND + len(right)]) & (right < left)) + AROUND
        first = np.unique(np.concatenate([inside[at], head]))
    row_end = np.append(head[1:], n)[np.searchsorted(head, first, "right") - 1]
    last = np.minimum(np.append(first[1:], n), row_end)
    first, last = first[last - first >= LENGTH], last[last - first >= LENGTH]
    return Paragraphs(row[first], first, last, sums(hashes)(first, last).view(np.int64))


def bands(hashes: np.ndarray, found: Paragraphs) -> np.ndarray:
    """One key per band of every paragraph."""
    grams = windows(hashes, SHINGLE)
    size = found.last - found.first - SHINGLE + 1
    edge = np.concatenate([[0], np.cumsum(size)])
    at = np.arange(edge[-1]) - np.repeat(edge[:-1] - found.first, size)
    grams = grams[at]
    keys = np.empty((len(size), BANDS), np.uint64)
    with np.errstate(over="ignore"):
        for band in range(BANDS):
            key = np.full(len(size), band + 1, np.uint64)
            for k in range(BAND_ROWS):
                salt = np.uint64((band * BAND_ROWS + k + 1) * 0x632BE59BD9B4E019 & (1 << 64) - 1)
                key = mixed(key * BASE + np.minimum.reduceat(mixed(grams ^ salt), edge[:-1]))
            keys[:, band] = key
    return keys


def key_rows(docs: DataFrame, text: str) -> DataFrame:
    """(key, node) of every band of every paragraph; node is the paragraph's signature."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            data, offsets = utf8(batch.column(0))
            for i, j in blocks(offsets):
                w = words(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], True)
                found = paragraphs(w.hash, w.row)
                _, at = np.unique(found.sig, return_index=True)
                at = np.array([k for k in at.tolist() if found.sig[k] not in seen], np.int64)
                if not len(at):
                    continue
                if len(seen) > REMEMBERED:
                    seen.clear()
                seen.update(found.sig[at].tolist())
                keys = bands(w.hash, Paragraphs(*(x[at] for x in found)))
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel().view(np.int64)), pa.array(np.repeat(found.sig[at], BANDS))], ["key", "node"])

    return mapped(docs.select(f"`{text}`"), work, "key long, node long")


def occurrences(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """sig, row_id, doc_id, start, end (code points, end exclusive) and n_words of every paragraph."""
    chosen = with_row_id(docs, doc_id, text)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(2))
            for i, j in blocks(offsets):
                part, edges = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
                w = words(part, edges, True)
                found = paragraphs(w.hash, w.row)
                points = code_points(part)
                zero = points[edges[found.row]]
                columns = [
                    pa.array(found.sig),
                    batch.column(0).take(pa.array(found.row + i)),
                    batch.column(1).take(pa.array(found.row + i)),
                    pa.array(points[w.start[found.first]] - zero),
                    pa.array(points[w.end[found.last - 1]] - zero),
                    pa.array(found.last - found.first),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["sig", "row_id", "doc_id", "start", "end", "n_words"])

    kind = chosen.schema["doc_id"].dataType.simpleString()
    return mapped(chosen, work, f"sig long, row_id long, doc_id {kind}, start long, end long, n_words long")


def texts_of(docs: DataFrame, found: DataFrame, nodes: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(node, text) of every node: cut out of one row in which it occurs.

    All nodes of a row are cut from it together, and rows of equal id and text are one."""
    side, _ = sized_side(nodes)
    first = found.join(side, found.sig == side.node, "left_semi").groupBy("sig")
    first = first.agg(F.min(F.struct("row_id", "start", "end")).alias("at"))
    asks = first.groupBy("at.row_id").agg(F.collect_list(F.struct("sig", "at.start", "at.end")).alias("asks"))
    rows = with_row_id(docs, doc_id, text).join(asks, "row_id").dropDuplicates(["row_id"])
    cell = rows.select("text", F.explode("asks").alias("ask"))
    part = F.substring(F.col("text"), F.col("ask.start").cast("int") + 1, (F.col("ask.end") - F.col("ask.start")).cast("int"))
    return cell.select(F.col("ask.sig").alias("node"), part.alias("text"))


def piece_rows(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Every piece: sig, row_id (of the id and text), doc_id, first and last (words), size (words of
    the row), start and end (code points)."""
    chosen = with_row_id(docs, doc_id, text)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(2))
            for i, j in blocks(offsets):
                part, edges = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
                w = words(part, edges, True)
                found = pieces(w.hash, w.row)
                points = code_points(part)
                zero = points[edges[found.row]]
                base = np.searchsorted(w.row, np.arange(j - i + 1))
                at = pa.array(found.row + i)
                columns = [
                    pa.array(found.sig), batch.column(0).take(at), batch.column(1).take(at),
                    *(pa.array((x - base[found.row]).astype(np.int32)) for x in (found.first, found.last, base[found.row + 1])),
                    pa.array((points[w.start[found.first]] - zero).astype(np.int32)),
                    pa.array((points[w.end[found.last - 1]] - zero).astype(np.int32)),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["sig", "row_id", "doc_id", "first", "last", "size", "start", "end"])

    kind = chosen.schema["doc_id"].dataType.simpleString()
    return mapped(chosen, work, f"sig long, row_id long, doc_id {kind}, first int, last int, size int, start int, end int")


def with_row_id(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(row_id(doc_id, text).alias("row_id"), F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))


def ends(docs: DataFrame, asked: DataFrame, doc_id: str, text: str) -> DataFrame:
    """For every asked piece and side (0 before, 1 behind) up to REACH words: row_id, doc_id, sig,
    first, side and, for each number of words from 1 on, ``keys`` (of the piece and these words),
    ``starts`` and ``stops`` (of these words)."""
    chosen = with_row_id(docs, doc_id, text)
    asks = asked.groupBy("row_id").agg(F.collect_set(F.struct("first", "last", "before", "behind")).alias("asks"))
    rows = chosen.join(asks, "row_id").select("row_id", "doc_id", "text", "asks")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(2))
            for i, j in blocks(offsets):
                part, edges = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
                w = words(part, edges, True)
                ranges, points = sums(w.hash), code_points(part)
                base = np.searchsorted(w.row, np.arange(j - i + 1))
                lists = batch.column(3).slice(i, j - i)
                row = np.repeat(np.arange(j - i), lists.value_lengths().to_numpy(zero_copy_only=False))
                first, last, before, behind = (x.to_numpy(zero_copy_only=False) for x in lists.flatten().flatten())
                first, last = first + base[row], last + base[row]
                sig = ranges(first, last)
                for side, wanted, most in ((0, before, first - base[row]), (1, behind, base[row + 1] - last)):
                    count = np.where(wanted, np.minimum(REACH, most), 0)
                    some = np.flatnonzero(count)
                    of = np.repeat(np.arange(len(row)), count)
                    n = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count) + 1
                    a, b = (first[of] - n, first[of]) if side == 0 else (last[of], last[of] + n)
                    with np.errstate(over="ignore"):
                        salt = mixed(sig[of] + np.uint64(side + 1) * BASE)
                        key = mixed(ranges(np.minimum(a, first[of]), np.maximum(b, last[of])) ^ salt)
                    zero = points[edges[row[of]]]
                    at, edge = pa.array(row[some] + i), pa.array(np.append(0, np.cumsum(count[some])).astype(np.int32))

                    def per_piece(values: np.ndarray, edge: pa.Array = edge) -> pa.Array:
                        return pa.ListArray.from_arrays(edge, pa.array(values))

                    columns = [
                        batch.column(0).take(at), batch.column(1).take(at), pa.array(sig[some].view(np.int64)),
                        pa.array((first[some] - base[row[some]]).astype(np.int32)), pa.array(np.full(len(some), side, np.int32)),
                        per_piece(key.view(np.int64)), per_piece((points[w.start[a]] - zero).astype(np.int32)),
                        per_piece((points[w.end[b - 1]] - zero).astype(np.int32)),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, ["row_id", "doc_id", "sig", "first", "side", "keys", "starts", "stops"])

    kind = chosen.schema["doc_id"].dataType.simpleString()
    schema = f"row_id long, doc_id {kind}, sig long, first int, side int, keys array<long>, starts array<int>, stops array<int>"
    return mapped(rows, work, schema)


def owners(rows: DataFrame, key: str, count: Column, low: str, high: str, low_row: str, high_row: str) -> DataFrame:
    """occurrences, component_doc and component_row of the values of ``key`` that several documents
    have. A row without an id is a document by itself, after all that have one."""
    whole = rows.groupBy(key).agg(
        F.sum(count).alias("occurrences"), F.min(low).alias("component_doc"), F.max(high).alias("high"),
        F.min(low_row).alias("component_row"), F.max(high_row).alias("high_row"),
    )
    named, unnamed = F.col("component_doc").isNotNull(), F.col("component_row").isNotNull()
    several = (F.col("component_doc") != F.col("high")) | (unnamed & (named | (F.col("component_row") != F.col("high_row"))))
    whole = whole.where(F.coalesce(several, unnamed & named))
    return whole.withColumn("component_row", F.when(~named, F.col("component_row"))).drop("high", "high_row")


def in_several(rows: DataFrame, key: str) -> DataFrame:
    unnamed = F.when(F.col("doc_id").isNull(), F.col("row_id"))
    rows = rows.select(key, "doc_id", unnamed.alias("unnamed"))
    return owners(rows, key, F.lit(1), "doc_id", "doc_id", "unnamed", "unnamed")


def is_later() -> Column:
    """Whether a row is not in the document that keeps its component."""
    kept = F.coalesce(F.col("doc_id") == F.col("component_doc"), F.col("row_id") == F.col("component_row"), F.lit(False))
    return ~kept


SPAN = ["row_id", "doc_id", "start", "end", "n_words", "component_id", "component_doc", "occurrences", "removed"]
# Numbers of words that are compared in one round; what no other document shares goes no further.
ROUNDS = ((0, 1), (1, 4), (4, REACH))


def shared_ends(reach: DataFrame) -> DataFrame:
    """Words next to a piece that several documents share with it, from stored ``ends``: the longest
    end shared with an earlier document, and a longer one shared with later ones only."""
    place = ["row_id", "doc_id", "sig", "first", "side"]
    found, active = None, reach
    for low, high in ROUNDS:
        cells = F.arrays_zip(*[F.slice(c, low + 1, high - low).alias(c) for c in ("keys", "starts", "stops")])
        rows = active.select(*place, F.posexplode(cells).alias("at", "cell")).select(
            *place, (F.col("at") + low + 1).cast("long").alias("n_words"), F.col("cell.keys").alias("key"),
            F.col("cell.starts").cast("long").alias("start"), F.col("cell.stops").cast("long").alias("end"),
        )
        several, _ = sized_side(in_several(rows, "key"))
        hits = stored(rows.join(several, "key").withColumn("removed", is_later()).drop("key"), "shared-ends")
        found = hits if found is None else found.unionByName(hits)
        if high < REACH:
            further = hits.where(F.col("n_words") == high).select(*place).distinct()
            same = F.lit(True)
            for c in place:
                same &= active[c].eqNullSafe(further[c])
            active = stored(active.join(further, same, "left_semi"), "open-ends")
    end = F.struct("n_words", "start", "end", "component_doc", "occurrences", "removed")
    best = found.groupBy(*place).agg(
        F.max(F.when(F.col("removed"), end)).alias("gone"), F.max(F.when(~F.col("removed"), end)).alias("kept")
    )
    longer = F.when(F.col("gone").isNull() | (F.col("kept.n_words") > F.col("gone.n_words")), F.col("kept"))
    best = best.select("row_id", "doc_id", F.col("sig").alias("component_id"), F.explode(F.array_compact(F.array("gone", longer))).alias("end"))
    return best.select("row_id", "doc_id", "component_id", "end.*").select(SPAN)


def runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Common runs of several documents: their whole pieces, and the words up to the ends of the
    run. Rows of equal id and text share the rows of these ends.

    Pieces are cut twice rather than stored, and what is stored on the way is released as soon as
    the rows it led to are stored themselves."""
    spark = docs.sparkSession
    with stored_copies(spark) as made:
        found = piece_rows(docs, doc_id, text)
        several, _ = sized_side(in_several(found, "sig"))
        whole = stored(found.join(several, "sig").withColumn("removed", is_later()), "marked")
        with stored_copies(spark) as inner:
            around = Window.partitionBy("row_id").orderBy("first")
            spots = stored(whole.select("row_id", "sig", "first", "last", "size", "removed").distinct(), "spots")
            # an end is asked of every occurrence of a piece if some later one has words there that stay
            later = spots.where("removed").withColumn("before", F.col("first") > F.coalesce(F.lag("last").over(around), F.lit(0)))
            later = later.withColumn("behind", F.col("last") < F.coalesce(F.lead("first").over(around), "size"))
            wanted = later.groupBy("sig").agg(F.max("before").alias("before"), F.max("behind").alias("behind"))
            wanted, _ = sized_side(wanted.where("before OR behind"))
            asked = spots.select("row_id", "sig", "first", "last").join(wanted, "sig")
            reach = stored(ends(docs, asked, doc_id, text), "ends")
            inner.pop()
        reach = shared_ends(reach)
        spans = whole.withColumn("n_words", (F.col("last") - F.col("first")).cast("long")).withColumnRenamed("sig", "component_id")
        spans = spans.withColumn("start", F.col("start").cast("long")).withColumn("end", F.col("end").cast("long"))
        out = stored(spans.select(SPAN).unionByName(reach), "runs")
        made.pop()
    return out


def similar_paragraphs(docs: DataFrame, doc_id: str, text: str, num: int, den: int) -> DataFrame:
    """Every occurrence of a paragraph whose component occurs in several documents."""
    with stored_copies(docs.sparkSession) as made:
        found = stored(occurrences(docs, doc_id, text), "paragraphs")
        buckets = stored(shared_buckets(key_rows(docs, text)), "bands")
        texts = stored(texts_of(docs, found, buckets.select("node").distinct(), doc_id, text), "paragraph-texts")
        groups = linked(buckets, lambda pairs: deltas(pairs, texts, SHINGLE, num, den), num, den)
        unnamed = F.when(F.col("doc_id").isNull(), F.col("row_id"))
        by_sig = found.withColumn("unnamed", unnamed).groupBy("sig").agg(
            F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("low"), F.max("doc_id").alias("high"),
            F.min("unnamed").alias("low_row"), F.max("unnamed").alias("high_row"),
        )
        # a paragraph alone in its component matters only if it occurs more than once
        placed = by_sig.join(groups, by_sig.sig == groups.node, "left").where("node IS NOT NULL OR n > 1")
        placed = stored(placed.withColumn("root", F.coalesce("root", "sig")).drop("node"), "placed")
        whole = owners(placed, "root", F.col("n"), "low", "high", "low_row", "high_row")
        named, _ = sized_side(placed.select("sig", "root").join(whole, "root"))
        rows = found.join(named, "sig").withColumn("removed", is_later()).withColumnRenamed("root", "component_id")
        out = stored(rows.select(SPAN), "similar")
        made.pop()
    return out


def repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", num: int = NUM, den: int = DEN) -> DataFrame:
    """Every occurrence of a paragraph or common run of several documents: row_id (of id and text),
    doc_id, start, end, n_words, component_id, component_doc (smallest id, null if no row has one),
    occurrences of the component, and removed."""
    return runs(docs, doc_id, text).unionByName(similar_paragraphs(docs, doc_id, text, num, den))


def cleaned(docs: DataFrame, found: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the removed occurrences; overlapping ones are cut out together."""
    spans = found.where("removed").groupBy(F.col("row_id").alias("cut_row"), F.col("doc_id").alias("cut_id"))
    spans = spans.agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("cut_spans"))
    # the input's columns ride in one, so their names cannot clash
    rows = docs.select(F.struct(*[f"`{c}`" for c in docs.columns]).alias("doc"), row_id(doc_id, text).alias("own_row"))
    same = (F.col("own_row") == F.col("cut_row")) & F.col(f"doc.`{doc_id}`").eqNullSafe(F.col("cut_id"))
    rows = rows.join(spans, same, "left").select(*[F.col(f"doc.`{c}`").alias(c) for c in docs.columns], "cut_spans")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text)
            out = []
            for body, cuts in zip(batch.column(at).to_pylist(), batch.column(batch.num_columns - 1).to_pylist(), strict=True):
                if body is not None and cuts:
                    parts, done = [], 0
                    for cut in cuts:
                        parts.append(body[done : max(done, cut["start"])])
                        done = max(done, cut["end"])
                    body = "".join([*parts, body[done:]])
                out.append(body)
            columns = [pa.array(out, pa.string()) if k == at else c for k, c in enumerate(batch.columns[:-1])]
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names[:-1])

    return mapped(rows, work, fields(docs))


def op6_passage_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every occurrence of a paragraph that repeats across documents."""
    return repeats(table(spark, folder, "documents").select("doc_id", "text"))
