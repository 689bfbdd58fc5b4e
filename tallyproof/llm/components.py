"""Connected components of an edge table by alternating large-star and small-star steps.

Each step is two aggregations and a join; the edges are written to the shared folder after every
round, so lineage stays short and a lost executor costs its own tasks only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyproof.llm.common import stored


def fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest node it reaches) of every node of ``edges`` (a, b).

    Loops and repeated edges are allowed; nodes are never null. An empty table gives an empty one.
    """
    links = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    links = stored(links.distinct(), "links")
    before = fingerprint(links)
    while True:
        # large-star: every larger neighbour of u hangs on the smallest neighbour of u
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small-star: the smaller neighbours of u, and u, hang on the smallest of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
        links = stored(small.where("u <> v").distinct(), "links")
        after = fingerprint(links)
        if after == before:
            roots = links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            return links.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
        before = after
