"""Vector code compression: integer product quantization with per-dimension value dictionaries.

Components become integers, vectors are cut into equal parts, and each part position has a codebook
of at most 256 entries, improved in rounds. The integers of a dimension take few values, so a task
keeps a dictionary of them per block of rows: the squared differences of every distinct integer to
all entries are tabulated once, and the distances of the block's parts are gathers from those tables
added over the dimensions. All arithmetic is in integers and exact.

Only sums per entry (parts x 256 rows from each task) move in a round, and codebooks (parts x 256
rows) are all that the driver holds. A lost executor costs its own tasks: rounds read a stored copy
of the integers, and a codebook follows from the sums alone.

Defined results: vectors that are null or hold a null or non-finite component are left out, and so
are vectors whose length is not that of the kept one with the smallest id. Rows without an id come
after all others when the first entries are chosen; equal ids are ordered by their vectors. Repeated
rows count each. Fewer than 256 rows give as many entries. Null labels are one label. An empty table
gives an empty one. A length that the parts do not divide and components of 2**14 and more, whose
distances could leave a long, are refused with an error.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyproof.llm.common import mapped, stored, table
from tallyproof.operators.sides import sized_side

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
# Rows whose distances are held at once: BLOCK x ENTRIES longs.
BLOCK = 4096
LARGEST = 2**14


def integers(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """vec_id, label and ``ints`` of the vectors that take part."""
    value = F.col(f"`{vector}`")
    finite = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    small = F.forall(value, lambda x: F.abs(x.cast("double")) < LARGEST)
    scaled = F.transform(value, lambda x: F.floor(x.cast("double") * SCALE))
    rows = vectors.where(value.isNotNull()).where(finite).select(
        F.col(f"`{vec_id}`").alias("vec_id"),
        F.col(f"`{label}`").alias("label"),
        F.when(small, scaled).otherwise(F.raise_error(F.lit(f"a component is not below {LARGEST}")).cast("array<bigint>")).alias("ints"),
    )
    return rows


def matrix(column: pa.Array) -> np.ndarray:
    """Equally long lists as the rows of a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return flat.reshape(len(column), -1)


def assigned(rows: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry and squared distance of every part; ``books`` is parts x entries x places."""
    parts, entries, width = books.shape
    codes = np.empty((len(rows), parts), np.int64)
    error = np.zeros(len(rows), np.int64)
    total = np.empty((len(rows), entries), np.int64)
    found = np.empty_like(total)
    at = np.arange(len(rows))
    for p in range(parts):
        total[:] = 0
        for j in range(width):
            values, code = np.unique(rows[:, p * width + j], return_inverse=True)
            differences = (values[:, None] - books[p, :, j]) ** 2
            np.take(differences, code, axis=0, out=found)
            total += found
        codes[:, p] = total.argmin(axis=1)
        error += total[at, codes[:, p]]
    return codes, error


def sums_of(rows: DataFrame, books: np.ndarray) -> dict[tuple[int, int], tuple[int, list[int]]]:
    """Per part and entry, how many parts are nearest to it and their sums by place."""
    parts, entries, width = books.shape
    shared = rows.sparkSession.sparkContext.broadcast(books)
    names = [f"s{j}" for j in range(width)]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros((parts, entries), np.int64)
        sums = np.zeros((parts, entries, width), np.int64)
        for batch in batches:
            block = matrix(batch.column(0))
            for i in range(0, len(block), BLOCK):
                own = block[i : i + BLOCK]
                codes, _ = assigned(own, shared.value)
                for p in range(parts):
                    count[p] += np.bincount(codes[:, p], minlength=entries)
                    for j in range(width):
                        # doubles hold these sums exactly: 2**12 rows of less than 2**24
                        sums[p, :, j] += np.bincount(codes[:, p], own[:, p * width + j], entries).astype(np.int64)
        part, entry = np.nonzero(count)
        columns = [part, entry, count[part, entry], *[sums[part, entry, j] for j in range(width)]]
        yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], ["part", "entry", "n", *names])

    schema = ", ".join(f"{c} bigint" for c in ["part", "entry", "n", *names])
    add = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ["n", *names]]
    found = mapped(rows.select("ints"), work, schema).groupBy("part", "entry").agg(*add).collect()
    shared.unpersist()
    return {(r["part"], r["entry"]): (int(r["n"]), [int(r[c]) for c in names]) for r in found}


def fitted(rows: DataFrame, rounds: int = ROUNDS, parts: int = PARTS, entries: int = ENTRIES) -> np.ndarray:
    """Codebooks (parts x entries x places) of stored ``ints``, from the rows of the smallest ids."""
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "ints").limit(entries).collect()
    start = np.array([r["ints"] for r in first], np.int64)
    width = start.shape[1] // parts
    books = np.ascontiguousarray(start.reshape(len(first), parts, width).swapaxes(0, 1))
    for _ in range(rounds):
        for (p, e), (n, sums) in sums_of(rows, books).items():
            books[p, e] = [s // n for s in sums]
    return books


def coded(rows: DataFrame, books: np.ndarray) -> DataFrame:
    """vec_id, label, ``code`` (two hex digits per part) and ``error`` of every row."""
    shared = rows.sparkSession.sparkContext.broadcast(books)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, len(batch), BLOCK):
                own = batch.slice(i, BLOCK)
                codes, error = assigned(matrix(own.column(2)), shared.value)
                text, size = codes.astype(np.uint8).tobytes().hex(), 2 * codes.shape[1]
                code = [text[k * size : (k + 1) * size] for k in range(len(codes))]
                yield pa.RecordBatch.from_arrays([own.column(0), own.column(1), pa.array(code, pa.string()), pa.array(error)], ["vec_id", "label", "code", "error"])

    kinds = rows.schema
    schema = f"vec_id {kinds['vec_id'].dataType.simpleString()}, label {kinds['label'].dataType.simpleString()}, code string, error bigint"
    return mapped(rows.select("vec_id", "label", "ints"), work, schema)


def kept(vectors: DataFrame, parts: int = PARTS) -> DataFrame:
    """A stored copy of the integers of one length."""
    rows = stored(integers(vectors), "vector-ints")
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "ints").limit(1).collect()
    length = len(first[0]["ints"]) if first else 0
    if length % parts:
        raise ValueError(f"vectors of {length} components cannot be cut into {parts} equal parts")
    return rows.where(F.size("ints") == length)


def books_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def compressed(vectors: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """Codes of all vectors that take part, and the codebooks."""
    rows = kept(vectors)
    books = fitted(rows) if rows.take(1) else np.empty((PARTS, 0, 0), np.int64)
    return coded(rows, books), books


def op13_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    """Codes and errors of all embeddings, with the error of each label."""
    rows, books = compressed(table(spark, folder, "embeddings"))
    rows = stored(rows, "vector-codes")
    # labels may be many: sent to all executors only when their stored size allows it
    labels, _ = sized_side(rows.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error")))
    return rows.join(labels, F.col("label").eqNullSafe(F.col("of"))).select(
        "vec_id", "code", "error", "label_error", F.lit(books_digest(books)).alias("codebooks_sha256")
    )


def _round(k: int, last: bool) -> str:
    """Nearest entries under book ``k`` and, but for the last, the next book."""
    near = f"""
near{k} AS MATERIALIZED (
  SELECT row, part, arg_min(entry, (d, entry)) AS entry, min(d) AS d FROM (
    SELECT x.row, x.part, b.entry, sum((x.v - b.v) * (x.v - b.v)) AS d
    FROM places x JOIN book{k} b ON b.part = x.part AND b.place = x.place GROUP BY ALL) GROUP BY row, part)"""
    book = f""",
book{k + 1} AS MATERIALIZED (
  SELECT part, entry, place, coalesce((s - ((s % n) + n) % n) // n, v) AS v
  FROM book{k} LEFT JOIN (
    SELECT part, entry, place, sum(x.v) AS s, count(*) AS n FROM places x JOIN near{k} USING (row, part) GROUP BY ALL)
  USING (part, entry, place))"""
    return near if last else near + book


ORACLE = f"""
WITH ints AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(x::DOUBLE * {SCALE})::BIGINT) AS v
  FROM embeddings WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
kept AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY vec_id NULLS LAST, v) AS row FROM ints),
places AS MATERIALIZED (
  SELECT row, (i - 1) // (len(v) // {PARTS}) AS part, (i - 1) % (len(v) // {PARTS}) AS place, v[i] AS v
  FROM (SELECT row, v, unnest(range(1, len(v) + 1)) AS i FROM kept)),
book0 AS MATERIALIZED (SELECT part, row - 1 AS entry, place, v FROM places WHERE row <= {ENTRIES}),
{",".join(_round(k, k == ROUNDS) for k in range(ROUNDS + 1))},
coded AS (
  SELECT k.vec_id, k.label, n.code, n.error FROM kept k JOIN (
    SELECT row, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(d)::BIGINT AS error
    FROM near{ROUNDS} GROUP BY row) n USING (row)),
books AS (SELECT sha256(string_agg(v::VARCHAR, ',' ORDER BY part, entry, place)) AS digest FROM book{ROUNDS})
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, digest AS codebooks_sha256
FROM coded, books
"""
