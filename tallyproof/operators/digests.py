"""Order-free digests of row ranges, compared from the top down before any row is joined.

A range is a partition (a date) and a bucket of its keys. Its digest is the number of rows, the sum
of one 64-bit hash per row and the exclusive or of another, so it does not depend on order and is
aggregated before it moves; a partition's digest is that of its ranges. Two sides are compared per
partition, then per range of those that differ, and only rows in differing ranges are paired.
Two unequal ranges pass as equal only if 128 bits of two hashes agree by chance.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyproof.operators.reconcile import field_mismatch
from tallyproof.operators.sides import sized_side
from tallyproof.sources.tables import frozen_relation

BUCKETS = 64
_RANGE = ["_part", "_bucket"]
_PARTS = ["rows", "null_keys", "hash_sum", "hash_xor"]


def row_hash(seed: int, columns: Sequence[str]) -> Column:
    """Hash of the values in order; a NULL is told apart from a value that is skipped."""
    cells = [x for c in columns for x in (F.col(c).isNull(), F.col(c))]
    return F.xxhash64(F.lit(seed), *cells)


def key_bucket(keys: Sequence[str], buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def range_digests(
    rows: DataFrame, part: Column, bucket: Column, keys: Sequence[str], fields: Sequence[str]
) -> DataFrame:
    """Digest of every range: ``_part`` (text), ``_bucket`` and the four parts of a digest."""
    columns = [*keys, *[f for f in fields if f not in keys]]
    missing = reduce(or_, [F.col(k).isNull() for k in keys])
    return rows.groupBy(part.cast("string").alias("_part"), bucket.alias("_bucket")).agg(
        F.count("*").alias("rows"),
        F.count_if(missing).alias("null_keys"),
        F.sum(row_hash(1, columns).cast("decimal(38,0)")).alias("hash_sum"),
        F.bit_xor(row_hash(2, columns)).alias("hash_xor"),
    )


def upper_digests(ranges: DataFrame) -> DataFrame:
    """Digest of every partition from those of its ranges, without the rows."""
    return ranges.groupBy("_part").agg(
        F.sum("rows").alias("rows"),
        F.sum("null_keys").alias("null_keys"),
        F.sum("hash_sum").cast("decimal(38,0)").alias("hash_sum"),
        F.bit_xor("hash_xor").alias("hash_xor"),
    )


def differing(left: DataFrame, right: DataFrame, at: Sequence[str]) -> DataFrame:
    """Places whose digests differ, or that one side lacks. Both sides are counted in one aggregate,
    as in ``key_counts``."""
    def side(digests: DataFrame, sign: int) -> DataFrame:
        return digests.select(*at, F.lit(sign).alias("_sign"), F.struct(*_PARTS).alias("_digest"))

    both = side(left, 1).unionByName(side(right, -1))
    per_digest = both.groupBy(*at, "_digest").agg(F.sum("_sign").alias("_net"))
    return per_digest.groupBy(*at).agg(F.bool_or(F.col("_net") != 0).alias("_differs")).where(
        "_differs"
    ).select(*at)


def compared_ranges(left: DataFrame, right: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Differing partitions, and the differing ranges inside them, of two stored digest tables."""
    parts = frozen_relation(differing(upper_digests(left), upper_digests(right), ["_part"]), "parts")

    def inside(ranges: DataFrame) -> DataFrame:
        return ranges.alias("r").join(
            parts.alias("p"), F.col("r._part").eqNullSafe(F.col("p._part")), "left_semi"
        )

    return parts, frozen_relation(differing(inside(left), inside(right), _RANGE), "ranges")


def rows_in(rows: DataFrame, part: Column, bucket: Column, ranges: DataFrame) -> DataFrame:
    """Rows of the given ranges; a broadcast filter while the ranges are few."""
    side, _ = sized_side(ranges.select(F.col("_part").alias("_p"), F.col("_bucket").alias("_b")))
    same = part.cast("string").eqNullSafe(F.col("_p")) & (bucket == F.col("_b"))
    return rows.join(side, same, "left_semi")


def range_summary(
    left: DataFrame, right: DataFrame, part: Column, bucket: Column,
    keys: Sequence[str], fields: Sequence[str],
) -> DataFrame:
    """Per partition: ranges and rows of both sides, ranges that differ and the rows in them."""
    sides = [
        frozen_relation(range_digests(side, part, bucket, keys, fields), "digests")
        for side in (left, right)
    ]
    _, ranges = compared_ranges(*sides)
    marks = ranges.select(F.col("_part").alias("_p"), F.col("_bucket").alias("_b"), F.lit(True).alias("_hit"))

    def counted(digests: DataFrame, name: str) -> DataFrame:
        same = F.col("_part").eqNullSafe(F.col("_p")) & (F.col("_bucket") == F.col("_b"))
        return digests.join(marks, same, "left").select(
            *_RANGE, F.lit(name).alias("_side"), "rows", F.coalesce("_hit", F.lit(False)).alias("_hit")
        )

    both = counted(sides[0], "l").unionByName(counted(sides[1], "r"))
    per_range = both.groupBy(*_RANGE).agg(
        F.bool_or("_hit").alias("_hit"),
        F.coalesce(F.sum(F.when(F.col("_side") == "l", F.col("rows"))), F.lit(0)).alias("_l"),
        F.coalesce(F.sum(F.when(F.col("_side") == "r", F.col("rows"))), F.lit(0)).alias("_r"),
    )
    return per_range.groupBy(F.col("_part").alias("part")).agg(
        F.count("*").alias("ranges"),
        F.sum("_l").alias("left_rows"),
        F.sum("_r").alias("right_rows"),
        F.count_if("_hit").alias("differing_ranges"),
        F.coalesce(F.sum(F.when(F.col("_hit"), F.col("_l") + F.col("_r"))), F.lit(0)).alias(
            "rows_to_compare"
        ),
    )


def ranged_field_mismatch(
    left: DataFrame,
    right: DataFrame,
    part: str,
    keys: Sequence[str],
    fields: Sequence[str],
    measures: Sequence[str] = (),
    buckets: int = BUCKETS,
) -> DataFrame:
    """``field_mismatch`` of two sides with unique keys, pairing only rows of ranges that differ.

    Rows of equal ranges have their twin in the same range, so they are counted from the digests;
    those with an incomplete key match nothing, as in a join. Where no range differs no row is
    joined at all. Each side is read once for its digests and, for differing ranges, once more.
    """
    bucket = key_bucket(keys, buckets)
    compared = [*fields, *[m for m in measures if m not in fields]]
    sides = [
        frozen_relation(range_digests(side, F.col(part), bucket, keys, compared), "digests")
        for side in (left, right)
    ]
    _, ranges = compared_ranges(*sides)
    if ranges.take(1):
        near = [rows_in(side, F.col(part), bucket, ranges) for side in (left, right)]
    else:
        near = [side.limit(0) for side in (left, right)]
    rows = field_mismatch(*near, keys, fields, measures)
    same = F.col("_part").eqNullSafe(F.col("_p")) & (F.col("_bucket") == F.col("_b"))
    marks = ranges.select(F.col("_part").alias("_p"), F.col("_bucket").alias("_b"))
    equal = sides[0].join(marks, same, "left_anti").agg(
        F.coalesce(F.sum(F.col("rows") - F.col("null_keys")), F.lit(0)).alias("_matched"),
        F.coalesce(F.sum("null_keys"), F.lit(0)).alias("_alone"),
    )
    added = {"matched_keys": "_matched", "left_only_keys": "_alone", "right_only_keys": "_alone"}
    zero = {f"{m}_row_difference_sum": F.lit(0).cast("decimal(38,6)") for m in measures}
    return rows.crossJoin(equal).select(
        *[(F.col(c) + F.col(added[c])).alias(c) if c in added
          else F.coalesce(F.col(c), zero[c]).alias(c) if c in zero else c for c in rows.columns]
    )
