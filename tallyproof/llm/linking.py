"""From index keys to groups of similar sets, without listing the pairs of a bucket.

Nodes are sets; those that share a key are candidates. Each bucket has a pivot, the member that is
in most buckets, and every other member is compared with it. What is left are similar pairs of
which not both sides are similar to the pivot. Let ``delta`` of a set be its symmetric difference
from the pivot; two sets differ in exactly the symmetric difference of their deltas. Such a pair
differs in at most ``H`` tokens while its deltas have more than ``H`` together:

    a set is similar when D <= k * (sum of sizes), with k = (den - num) / (den + num). If b is not
    similar to p, |delta b| > k (|b| + |p|). Were |delta a| + |delta b| <= k (|a| + |b|), then with
    |a| <= |p| + |delta a| it would be at most k (|p| + |b|) + k |delta a| < |delta b| + |delta a|.

So the deltas share a token; by the prefix filter they share one among the first H + 1 of each, in
one order for all deltas of a pivot, tokens of the fewest deltas first. So copies edited apart meet
hardly anyone, however large their group; and a token far back in a delta leaves too few behind it
to reach the number that must be shared. Members of a token meet its hub first, as
many pairs as members; what is then still of different components is verified pair by pair, again
exactly and by the deltas.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyproof.llm.common import stored
from tallyproof.llm.components import components
from tallyproof.operators.sides import sized_side
from tallyproof.session import stored_copies


def shared_buckets(keys: DataFrame) -> DataFrame:
    """Rows (key, node) of the keys that two or more different nodes have."""
    bucket = Window.partitionBy("key")
    return (
        keys.withColumn("low", F.min("node").over(bucket))
        .withColumn("high", F.max("node").over(bucket))
        .where("low <> high")
        .select("key", "node")
    )


def divided(rows: DataFrame, *place: str) -> DataFrame:
    """Places whose rows are of two or more components: an aggregate that shrinks before it moves."""
    ends = rows.groupBy(*place).agg(F.min("root").alias("low"), F.max("root").alias("high"))
    return ends.where("low <> high").select(*place)


def stars(buckets: DataFrame) -> DataFrame:
    """Distinct (node, pivot): every member of a bucket with the bucket's pivot."""
    degree = buckets.groupBy("node").agg(F.count(F.lit(1)).alias("degree"))
    order = F.struct("degree", F.xxhash64("node"), "node")
    # one row per bucket, which its members are joined with: a large bucket can be split
    tops = buckets.join(degree, "node").groupBy("key").agg(F.max(order).alias("top"))
    rows = buckets.join(tops, "key").select("node", F.col("top.node").alias("pivot"))
    return rows.where("node <> pivot").distinct()


def similar(common: Column, left: Column, right: Column, num: int, den: int) -> Column:
    return den * common >= num * (left + right - common)


def verified(met: DataFrame, open_rows: DataFrame, num: int, den: int) -> DataFrame:
    """The similar ones of the pairs (pivot, a, b), by the deltas of both sides from the pivot."""
    def side(name: str) -> DataFrame:
        return open_rows.select("pivot", F.col("node").alias(name), F.col("size").alias(f"{name}_size"), F.col("delta").alias(f"{name}_delta"))

    rows = met.join(side("a"), ["pivot", "a"]).join(side("b"), ["pivot", "b"])
    both = F.size(F.array_intersect("a_delta", "b_delta"))
    differing = F.size("a_delta") + F.size("b_delta") - 2 * both
    sizes = F.col("a_size") + F.col("b_size")
    return rows.where(similar((sizes - differing) / 2, F.col("a_size"), F.col("b_size"), num, den)).select("a", "b")


def linked(buckets: DataFrame, deltas: Callable[[DataFrame], DataFrame], num: int, den: int) -> DataFrame:
    """``node`` and ``root`` of every node that is similar to another one of its buckets.

    ``buckets``: stored rows (key, node). ``deltas`` takes pairs (node, pivot) and adds size, good
    (similar to the pivot) and delta (array of tokens in prefix order).
    """
    spark = buckets.sparkSession
    with stored_copies(spark) as made:
        out = stored(_linked(buckets, deltas, num, den), "groups")
        made.pop()
    return out


def _linked(buckets: DataFrame, deltas: Callable[[DataFrame], DataFrame], num: int, den: int) -> DataFrame:
    star = stored(deltas(stored(stars(buckets), "stars")), "deltas")
    near = star.where("good").select(F.col("node").alias("a"), F.col("pivot").alias("b"))
    groups = stored(components(near), "groups")

    own = groups.select(F.col("node").alias("member"), F.col("root").alias("known"))
    named = star.join(own, star.node == own.member, "left").withColumn("root", F.coalesce("known", "node"))
    # a pivot whose members all fell in one component has nothing left to link
    several, _ = sized_side(divided(named, "pivot"))
    open_rows = named.join(several, "pivot", "left_semi").select("pivot", "node", "root", "size", "delta")
    open_rows = stored(open_rows, "open")
    most = F.floor(F.lit(den - num) * F.col("size") / num).cast("int")
    left = (F.col("n") - F.col("place")).alias("left")
    every = open_rows.select("pivot", "node", "root", "size", F.size("delta").alias("n"), most.alias("most"), F.explode("delta").alias("token"))
    # one order for all deltas of a pivot: tokens that few of them have come first, so that what all
    # have alike, such as an edit of the pivot itself, is met at the end of a prefix if at all
    seen = every.groupBy("pivot", "token").agg(F.count(F.lit(1)).alias("held"), F.min("root").alias("low"), F.max("root").alias("high"))
    rank = F.row_number().over(Window.partitionBy("pivot", "node").orderBy("held", "token")) - 1
    tokens = every.join(seen, ["pivot", "token"]).withColumn("place", rank)
    tokens = tokens.where((F.col("place") <= F.col("most")) & (F.col("low") != F.col("high")))
    tokens = stored(tokens.select("pivot", "node", "root", "token", "size", "n", left), "tokens")
    # members of a token first meet its hub alone, which joins most of what belongs together
    degree = tokens.groupBy("pivot", "node").agg(F.count(F.lit(1)).alias("degree"))
    order = F.struct("degree", F.xxhash64("node"), "node", "root")
    tops = tokens.join(degree, ["pivot", "node"]).groupBy("pivot", "token").agg(F.max(order).alias("top"))
    met = tokens.join(tops, ["pivot", "token"]).where(F.col("root") != F.col("top.root"))
    met = met.select("pivot", F.col("node").alias("a"), F.col("top.node").alias("b")).distinct()
    closer = stored(verified(met, open_rows, num, den), "closer")
    if closer.take(1):
        edges = groups.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(closer)
        groups = stored(components(edges), "groups")
        known = groups.select("node", F.col("root").alias("now"))
        tokens = tokens.join(known, "node", "left").withColumn("root", F.coalesce("now", "root")).drop("now")
        shared, _ = sized_side(divided(tokens, "pivot", "token"))
        tokens = stored(tokens.join(shared, ["pivot", "token"], "left_semi"), "tokens")
    other = tokens.select("pivot", "token", *[F.col(c).alias(f"b_{c}") for c in ("node", "root", "size", "n", "left")])
    # tokens that deltas of these lengths must share; from their first common token on, no more
    # than what is left of the shorter rest can be shared
    apart = F.floor(F.lit(den - num) * (F.col("size") + F.col("b_size")) / (den + num))
    need = F.col("n") + F.col("b_n") - apart
    met = tokens.join(other, ["pivot", "token"]).where((F.col("root") < F.col("b_root")) & (2 * F.least("left", "b_left") >= need))
    met = met.groupBy(F.least("node", "b_node").alias("a"), F.greatest("node", "b_node").alias("b"))
    further = verified(met.agg(F.min("pivot").alias("pivot")), open_rows, num, den)
    further = stored(further, "further")
    if not further.take(1):
        return groups
    edges = groups.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(further)
    return stored(components(edges), "groups")
