"""Sharding by vector bin packing: bytes, tokens and rows are balanced jointly.

Documents with equal texts form a group. Its rows have equal bytes and tokens, so one row gives the
direction of the group's vector. Groups that matter by themselves (over 1/4096 of any total) are
packed as they are; the others in parcels of like groups: a class holds texts whose bytes and tokens
have the same powers of two, and is cut by a hash of the text into parcels in proportion to its
share of the totals. So vectors decide at any size, while the packing looks at a number of items
bounded by parameters, whatever the number of documents. Each item goes to the shard whose residual
capacity has the largest dot product with it; a closing pass exchanges items between the fullest and
the emptiest shard until bytes agree, at the least cost to tokens and rows. A group larger than half
a shard is split into pieces of about a quarter of a shard.

Defined results: a null text has size 1 and no tokens; null and empty texts are different groups of
equal size. Repeated rows are separate rows of one group, split like others where the group is
large: rows are dealt to its pieces by their number in the stored table, not by their ids. An empty
table gives an empty table.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyproof.llm.common import stored, table

SHARDS = 16
# Parcels of small groups for each total, and buckets in which the rows of a shard are numbered.
PARCELS, BUCKETS = 4096, 256
MEASURES = ["size", "tokens", "rows"]
# Closing exchanges: most rounds, items of a shard looked at, weight of bytes at the end.
ROUNDS, SEEN, BYTES_FIRST = 1000, 256, 1e6


def shares(items: np.ndarray, shards: int) -> np.ndarray:
    """Measures of each item in units of one shard's even share."""
    total = items.sum(axis=0)
    return np.divide(items * shards, total, out=np.zeros(items.shape), where=total > 0)


def packed(share: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each item, largest items first, where residual capacity points its way most."""
    residual = np.ones((shards, share.shape[1]))
    place = np.zeros(len(share), np.int64)
    for i in np.argsort(-share.max(axis=1), kind="stable"):
        place[i] = int(np.argmax(residual @ share[i]))
        residual[place[i]] -= share[i]
    return place


def exchanged(share: np.ndarray, place: np.ndarray, load: np.ndarray, weights: np.ndarray, measure: int) -> bool:
    """Makes the move or exchange between the fullest and the emptiest shard of one measure that lowers
    the weighted squares of all loads most; False if none does. Of a shard's items ``SEEN`` are looked
    at, spread evenly over their sizes."""
    high, low = int(load[:, measure].argmax()), int(load[:, measure].argmin())
    sides = []
    for shard in (high, low):
        items = np.flatnonzero(place == shard)
        items = items[np.argsort(share[items, measure], kind="stable")]
        sides.append(items[np.linspace(0, len(items) - 1, min(len(items), SEEN)).astype(np.int64)] if len(items) else items)
    given, taken = sides[0], np.append(sides[1], -1)
    back = np.vstack([share[sides[1]], np.zeros((1, share.shape[1]))])
    step = share[given][:, None, :] - back[None, :, :]
    gain = (weights * step * (load[high] - load[low] - step)).sum(2)
    if not gain.size or gain.max() <= 1e-15:
        return False
    i, j = np.unravel_index(int(gain.argmax()), gain.shape)
    place[given[i]] = low
    if taken[j] >= 0:
        place[taken[j]] = high
    load[high] -= step[i, j]
    load[low] += step[i, j]
    return True


def evened(share: np.ndarray, place: np.ndarray, shards: int) -> np.ndarray:
    """``place`` after exchanges between the fullest and emptiest shards: of all measures alike first,
    then with ``BYTES_FIRST`` times the weight for the first, whose law is stated."""
    load = np.stack([np.bincount(place, column, shards) for column in share.T], 1)
    for first in (1.0, BYTES_FIRST):
        weights = np.array([first, *[1.0] * (share.shape[1] - 1)])
        for _ in range(ROUNDS):
            if not any([exchanged(share, place, load, weights, m) for m in range(share.shape[1])]):
                break
    return place


def hashed(n: int, *parts: Column | str) -> Column:
    return F.pmod(F.xxhash64(*parts), F.lit(n)).cast("int")


def sharded(
    docs: DataFrame, shards: int = SHARDS, parcels: int = PARCELS, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of every row."""
    spark = docs.sparkSession
    body = F.col(f"`{text}`")
    base = stored(
        docs.select(
            F.col(f"`{doc_id}`").alias("doc_id"),
            (F.coalesce(F.octet_length(body), F.lit(0)) + 1).cast("long").alias("size"),
            F.coalesce(F.regexp_count(body, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long").alias("tokens"),
            F.crc32(F.encode(F.coalesce(body, F.lit("")), "UTF-8")).cast("long").alias("text_crc32"),
            F.coalesce(F.md5(F.encode(body, "UTF-8")), F.lit("null")).alias("group"),
            F.monotonically_increasing_id().alias("number"),  # fixed once stored
        ),
        "shard-base",
    )
    sums = [F.sum("size").alias("size"), F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("rows")]
    whole = base.agg(*sums).first()
    share = F.greatest(*[F.col(c) / F.lit(float(max(1, whole[c] or 0))) for c in MEASURES])
    # At most 3 * parcels groups exceed 1 / parcels of one of three totals: a bounded broadcast.
    large = (
        base.groupBy("group").agg(*sums).withColumn("share", share)
        .where(F.col("share") > 1 / parcels)
        .select("group", F.when(F.col("share") * shards > 0.5, F.ceil(F.col("share") * shards * 4)).otherwise(1).cast("int").alias("pieces"))
    )
    power = [F.floor(F.log2(F.col(c) + 1)).cast("string") for c in ("size", "tokens")]
    rows = base.join(F.broadcast(large), "group", "left").withColumn("class", F.concat_ws("-", *power))
    # At most 32 powers of two of either measure: a bounded broadcast.
    classes = (
        rows.where("pieces IS NULL").groupBy("class").agg(*sums)
        .select("class", F.ceil(share * parcels).cast("int").alias("parcels"))
    )
    piece, parcel = F.pmod("number", "pieces"), F.pmod(F.xxhash64("group"), F.col("parcels"))
    item = F.when(F.col("pieces").isNotNull(), F.concat_ws("/", "group", piece)).otherwise(F.concat_ws("/", "class", parcel))
    rows = rows.join(F.broadcast(classes), "class", "left").withColumn("item", item)
    # At most 3 * parcels parcels and one for each class, 3 * parcels groups and 3 * 4 * shards pieces.
    items = rows.groupBy("item").agg(*sums).orderBy("item").collect()
    measures = np.array([[float(r[c]) for c in MEASURES] for r in items]).reshape(-1, len(MEASURES))
    need = shares(measures, shards)
    place = evened(need, packed(need, shards), shards) if items else []
    where = spark.createDataFrame([(r["item"], int(p)) for r, p in zip(items, place, strict=True)], "item string, shard int")
    rows = stored(
        rows.join(F.broadcast(where), "item").select(
            "doc_id", "size", "text_crc32", "shard", "number", hashed(BUCKETS, "number").alias("bucket")
        ),
        "shard-rows",
    )
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        rows.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("n"))
        .select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    )
    inside = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy("number"))
    return (
        rows.withColumn("inside", inside - 1)
        .join(F.broadcast(offsets), ["shard", "bucket"])
        .select("doc_id", "size", "text_crc32", "shard", (F.col("offset") + F.col("inside")).cast("long").alias("slot"))
    )


def op8_vector_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in 16 shards of nearly equal bytes."""
    out = sharded(table(spark, folder, "documents").select("doc_id", "text"))
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
