"""Quality classifier by supervised subword embeddings.

A document is the average of learned vectors of its hashed features: words, pairs of neighbouring
words, and 3- and 4-grams of the characters of each word between two boundary marks. A softmax over two classes follows. Vectors and output weights are
trained together by stochastic gradient descent in numpy, on a bounded sample of labelled rows.

As averaging and the output are linear, a feature adds the same amount to the logit wherever it
occurs; scoring therefore looks up one number per feature instead of a vector.

Pairs are hashed by the difference of their words' hashes, so that all repetitions of a word share
one bucket. Labels, language, source and id are never inputs of a score.

Characters are code points; n-grams do not run from one word into the next.

Defined results: null and empty texts, and texts of white space, have no features and get the score of the bias. Labels that
are null are ignored; several labels of one id count by their mean, 0.5 as 1. Without labels of
both classes every score is 0.5. Repeated rows get equal scores.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyproof.llm.common import blocks, fields, mapped, table, utf8, without
from tallyproof.llm.words import BASE, SPACE, Words, byte_values, mixed, windows, words

BUCKETS, DIM = 1 << 15, 16
GRAMS = (3, 4)
# Marks before and after each word.
LEFT, RIGHT = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)
# Most labelled rows that the model is fitted on, in the order of a hash of their ids.
TRAIN_ROWS = 2000
EPOCHS, BATCH, RATE, SEED = 12, 32, 0.3, 7


class Model(NamedTuple):
    """Share of each feature bucket in the logit of class 1, and its bias."""

    weight: np.ndarray
    bias: float


def bucket(hashes: np.ndarray, kind: int) -> np.ndarray:
    return (mixed(hashes + np.uint64(kind) * BASE) & np.uint64(BUCKETS - 1)).astype(np.int64)


def characters(data: np.ndarray, w: Words) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the characters of all words, each word between two marks, and the word of each entry."""
    lead = (data & 0xC0) != 0x80
    before = np.concatenate([[0], np.cumsum(lead)])
    sizes = before[w.end] - before[w.start]
    at = np.flatnonzero(lead & ~SPACE[data])
    values = byte_values()[data[at]]
    wide = np.flatnonzero(data[at] >= 0xC0)
    code = data[at[wide]].astype(np.uint64)
    for j in range(1, 4):
        place = np.minimum(at[wide] + j, len(data) - 1)
        code = np.where(before[place + 1] == before[at[wide] + 1], code << np.uint64(8) | data[place], code)
    values[wide] = mixed(code * BASE)
    word = np.repeat(np.arange(len(sizes)), sizes + 2)
    first = np.cumsum(sizes + 2) - (sizes + 2)
    out = np.full(len(word), LEFT)
    out[first + sizes + 1] = RIGHT
    out[np.arange(len(at)) + 2 * np.repeat(np.arange(len(sizes)), sizes) + 1] = values
    return out, word


def features(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows and buckets of all features, one kind after the other."""
    with np.errstate(over="ignore"):
        w = words(data, offsets)
        yield w.row, bucket(w.hash, 1)
        same = np.flatnonzero(w.row[1:] == w.row[:-1])
        yield w.row[same], bucket(w.hash[same + 1] - w.hash[same], 2)
        values, word = characters(data, w)
        for n in GRAMS:
            if len(word) >= n:
                inside = np.flatnonzero(word[: len(word) - n + 1] == word[n - 1 :])
                yield w.row[word[inside]], bucket(windows(values, n)[inside], n)


def logits(model: Model, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    rows = len(offsets) - 1
    total, count = np.zeros(rows), np.zeros(rows)
    for row, place in features(data, offsets):
        total += np.bincount(row, model.weight[place], rows)
        count += np.bincount(row, minlength=rows)
    return total / np.maximum(count, 1) + model.bias


def bags(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without the text, with its feature counts: at most BUCKETS pairs for any length."""
    chosen = docs.select(*without(docs, "places", "counts"))
    rest = chosen.drop(text)
    names = [*rest.columns, "places", "counts"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text)
            data, offsets = utf8(batch.column(at))
            places, counts = [], []
            for i, j in zip(offsets[:-1], offsets[1:], strict=True):
                count = np.zeros(BUCKETS, np.int64)
                for _, place in features(data[i:j], np.array([0, j - i])):
                    count += np.bincount(place, minlength=BUCKETS)
                used = np.flatnonzero(count)
                places.append(used.astype("<u2").tobytes())
                counts.append((count[used] / max(1, count.sum())).astype("<f4").tobytes())
            columns = [c for k, c in enumerate(batch.columns) if k != at]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(places, pa.binary()), pa.array(counts, pa.binary())], names)

    return mapped(chosen, work, f"{fields(rest)}, places binary, counts binary")


def trained(places: list[bytes], counts: list[bytes], labels: np.ndarray, seed: int = SEED) -> Model:
    """Gradient descent over shuffled batches; steps shrink with each weight's past gradients."""
    if len(set(labels.tolist())) < 2:
        return Model(np.zeros(BUCKETS), 0.0)
    chance = np.random.default_rng(seed)
    vectors = chance.uniform(-1, 1, (BUCKETS, DIM)).astype(np.float32) / DIM
    out, bias = (chance.uniform(-1, 1, (DIM, 2)) / DIM).astype(np.float32), np.zeros(2, np.float32)
    past = [np.full_like(x, 1e-6) for x in (vectors, out, bias)]
    scale = np.float32(30)
    for _ in range(EPOCHS):
        for rows in np.array_split(chance.permutation(len(labels)), -(-len(labels) // BATCH)):
            x = np.zeros((len(rows), BUCKETS), np.float32)
            for i, r in enumerate(rows):
                x[i, np.frombuffer(places[r], "<u2")] = np.frombuffer(counts[r], "<f4") * scale
            hidden = x @ vectors
            score = hidden @ out + bias
            share = np.exp(score - score.max(1, keepdims=True))
            share /= share.sum(1, keepdims=True)
            share[np.arange(len(rows)), labels[rows]] -= 1
            share /= len(rows)
            steps = (x.T @ (share @ out.T), hidden.T @ share, share.sum(0))
            for value, step, sums, rate in zip((vectors, out, bias), steps, past, (RATE, RATE / 3, RATE / 3), strict=True):
                sums += step * step
                value -= rate / 3 * step / np.sqrt(sums)
    margin = (out[:, 1] - out[:, 0]).astype(np.float64)
    return Model(scale * (vectors @ margin), float(bias[1] - bias[0]))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 3 == 1, F.lit(False))


def fitted(docs: DataFrame, labels: DataFrame, most: int = TRAIN_ROWS) -> Model:
    """The model of the labelled rows outside the held-out third, ``most`` of them at the most."""
    known = (
        labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").where(~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    )
    # ``known`` has at most ``most`` rows of two numbers, so it may be broadcast.
    rows = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").select("doc_id", "quality", "text")
    got = bags(rows).orderBy(F.xxhash64("doc_id"), "doc_id", "counts").limit(2 * most).collect()
    return trained([r["places"] for r in got], [r["counts"] for r in got], np.array([r["quality"] for r in got], np.int64))


def scored(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``score``, the probability of class 1."""
    chosen = docs.select(*without(docs, "score"))
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(batch.schema.get_field_index(text)))
            for i, j in blocks(offsets):
                logit = logits(sent.value, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                score = 1 / (1 + np.exp(-np.clip(logit, -500, 500)))
                yield pa.RecordBatch.from_arrays([*batch.slice(i, j - i).columns, pa.array(score)], [*batch.schema.names, "score"])

    return mapped(chosen, work, f"{fields(chosen)}, score double")


def op5_subword_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Every document scored by a model of the labels outside the held-out third."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = fitted(docs, table(spark, folder, "labels"))
    return scored(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
