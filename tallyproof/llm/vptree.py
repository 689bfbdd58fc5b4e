"""Approximate nearest neighbours with vantage-point trees, one per shard.

Vectors are dealt by hash into shards of bounded size; each shard becomes a balanced tree whose
inner nodes keep a vantage point and the range of distances on either side of it. A search descends
with all queries of a block at once and leaves out a side whose lower bound by the triangle
inequality, times ``relax``, exceeds the distance of the k-th neighbour found so far. ``relax`` one
is exact; larger factors leave out more. The best of every shard are merged.

Defined results: vectors that are null, empty, all zero or hold a null or non-finite component, and
rows without an id, take no part. Rows equal in id and vector count once; candidates with the
query's id are its own. Vectors of another length than the query's are no candidates. Ties go to
the smaller id. Fewer candidates than ``k`` give fewer rows; an empty table gives none.
"""

from __future__ import annotations

import io
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyproof.llm.common import ship, stored, table

# Rows of a tree, queries that descend together, and rows of a leaf.
SHARD_ROWS, BLOCK_ROWS, LEAF_ROWS = 8192, 4096, 192
# Measured on the test tables against brute force: see the README.
RELAX = 2.0
SEED = 17


class Tree(NamedTuple):
    """Rows in tree order; per node the vantage point, the row ranges of both sides (or the leaf's
    own) and their least and greatest distances from it."""

    ids: np.ndarray
    vectors: np.ndarray
    points: np.ndarray
    spans: np.ndarray
    bounds: np.ndarray
    children: np.ndarray


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of the rows of ``a`` from the rows of ``b``."""
    out = np.empty((len(a), len(b)))
    step = max(1, (1 << 21) // max(1, b.size))
    for i in range(0, len(a), step):
        out[i : i + step] = np.sqrt(((a[i : i + step, None, :] - b[None]) ** 2).sum(-1))
    return out


def build(ids: np.ndarray, vectors: np.ndarray, seed: int = SEED) -> Tree:
    """Balanced tree; sides are cut by rank, so equal distances cannot unbalance it."""
    chance = np.random.default_rng(seed)
    order = np.arange(len(ids))
    points, spans, bounds, children = [], [], [], []

    def grow(low: int, high: int) -> int:
        node = len(points)
        points.append(np.zeros(vectors.shape[1]))
        spans.append((low, high))
        bounds.append((0.0, 0.0, 0.0, 0.0))
        children.append((-1, -1))
        if high - low <= LEAF_ROWS:
            return node
        own = order[low:high]
        tried = vectors[chance.choice(own, min(5, len(own)), replace=False)]
        far = distances(tried, vectors[chance.choice(own, min(64, len(own)), replace=False)])
        points[node] = tried[far.std(axis=1).argmax()]
        gap = distances(points[node][None], vectors[own])[0]
        rank = np.argsort(gap, kind="stable")
        order[low:high], gap = own[rank], gap[rank]
        half = (high - low) // 2
        bounds[node] = (gap[0], gap[half - 1], gap[half], gap[-1])
        children[node] = (grow(low, low + half), grow(low + half, high))
        return node

    grow(0, len(ids))
    return Tree(ids[order], vectors[order], np.array(points), np.array(spans), np.array(bounds), np.array(children))


def search(tree: Tree, query_ids: np.ndarray, queries: np.ndarray, k: int, relax: float) -> tuple[np.ndarray, np.ndarray]:
    """Ids and distances of the nearest rows found for every query, nearest first; -1 where there
    are fewer than ``k``."""
    best = np.full((len(queries), k), np.inf)
    found = np.full((len(queries), k), np.iinfo(np.int64).max)

    def visit(node: int, rows: np.ndarray) -> None:
        if not len(rows):
            return
        if tree.children[node, 0] < 0:
            low, high = tree.spans[node]
            gap = distances(queries[rows], tree.vectors[low:high])
            gap[tree.ids[None, low:high] == query_ids[rows, None]] = np.inf
            nearer = gap.min(1) <= best[rows, -1]
            rows, gap = rows[nearer], gap[nearer]
            ids = np.broadcast_to(tree.ids[low:high], gap.shape)
            gap, ids = np.concatenate([best[rows], gap], 1), np.concatenate([found[rows], ids], 1)
            first = np.lexsort((ids, gap), axis=-1)[:, :k]
            best[rows], found[rows] = np.take_along_axis(gap, first, 1), np.take_along_axis(ids, first, 1)
            return
        gap = distances(queries[rows], tree.points[node][None])[:, 0]
        low_in, high_in, low_out, high_out = tree.bounds[node]
        inner = np.maximum(0, np.maximum(low_in - gap, gap - high_in))
        outer = np.maximum(0, np.maximum(low_out - gap, gap - high_out))
        sides = [(tree.children[node, 0], inner), (tree.children[node, 1], outer)]
        for own, order in ((inner <= outer, sides), (inner > outer, sides[::-1])):
            for child, bound in order:
                # rounding of the distances must not cut off an equal neighbour
                visit(child, rows[own & (bound * relax <= best[rows, -1] * (1 + 1e-9))])

    visit(0, np.arange(len(queries)))
    return np.where(np.isfinite(best), found, -1), best


def packed(tree: Tree) -> bytes:
    out = io.BytesIO()
    np.savez(out, **tree._asdict())
    return out.getvalue()


def unpacked(data: bytes) -> Tree:
    parts = np.load(io.BytesIO(data))
    return Tree(*(parts[name] for name in Tree._fields))


def usable(vector: Column) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & ~bad & F.exists(vector, lambda x: x != 0)


def candidates(rows: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """id, vector (doubles) and dim of the rows that take part."""
    vector = F.col(f"`{embedding}`").cast("array<double>")
    chosen = rows.select(F.col(f"`{vec_id}`").cast("long").alias("id"), vector.alias("vector"))
    # an unusable row must not reach a condition on its components
    chosen = chosen.where("id IS NOT NULL").where(F.when(F.col("vector").isNull(), False).otherwise(usable(F.col("vector"))))
    return chosen.dropDuplicates(["id", "vector"]).withColumn("dim", F.size("vector"))


def indexed(rows: DataFrame, shard_rows: int = SHARD_ROWS) -> tuple[DataFrame, int]:
    """One tree per dim and shard, stored, and the number of shards. ``rows`` as from candidates."""
    ship(rows.sparkSession)
    shards = max(1, -(-rows.count() // shard_rows))

    def make(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("id", kind="stable")
        tree = build(frame["id"].to_numpy(np.int64), np.stack(frame["vector"].to_list()).astype(np.float64))
        return pd.DataFrame({"dim": [frame["dim"].iloc[0]], "shard": [frame["shard"].iloc[0]], "tree": [packed(tree)]})

    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("id", "vector"), F.lit(shards)).cast("int"))
    trees = dealt.groupBy("dim", "shard").applyInPandas(make, "dim int, shard int, tree binary")
    return stored(trees, "trees"), shards


def nearest(
    trees: DataFrame, shards: int, queries: DataFrame, k: int = 10, relax: float = RELAX, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """query_id, rank, vec_id and score of the ``k`` nearest found. ``queries`` as from candidates.

    Every block of queries meets every tree once; a task holds one tree and one block.
    """
    ship(queries.sparkSession)
    blocks = max(1, -(-queries.count() // block_rows))

    def find(tree: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if not len(tree) or not len(asked):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        ids = asked["id"].to_numpy(np.int64)
        found, score = search(unpacked(tree["tree"].iloc[0]), ids, np.stack(asked["vector"].to_list()), k, relax)
        good = np.isfinite(score)
        return pd.DataFrame({"query_id": np.repeat(ids, k)[good.ravel()], "vec_id": found[good], "score": score[good]})

    dealt = queries.select(
        "id", "vector", "dim",
        F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"),
    )
    copied = trees.select("dim", "shard", "tree", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    keys = ["dim", "shard", "block"]
    met = copied.groupBy(*keys).cogroup(dealt.groupBy(*keys)).applyInPandas(find, "query_id long, vec_id long, score double")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return met.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op2_vptree(spark: SparkSession, folder: str) -> DataFrame:
    """The 10 nearest vectors of every vector whose id is divisible by 100."""
    rows = candidates(table(spark, folder, "embeddings"))
    trees, shards = indexed(rows)
    return nearest(trees, shards, rows.where("id % 100 = 0"))
