"""Ordered scans that stay parallel when one key holds most of the rows.

A plain window puts a whole key into one task. Here a key is cut into segments that follow
the order (block ranges, days). Each segment is scanned on its own, and a summary of one row per
segment, aggregated before it moves, is scanned per key. Both meet on ``(key, segment)``, which is
the partitioning the large side already has, so its rows move once.
The input is read twice, the second time for keys and order only (rows with a value once more if
``sparse``): store an expensive one first.
Key columns must not be NULL.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_SEG = "_segment"


@dataclass(frozen=True)
class Carry:
    """What to carry: the nearest non-null ``value`` at or before (or after) each row."""

    value: str
    out: str
    backward: bool = False
    include_current: bool = True


def _beside(summary: DataFrame) -> DataFrame:
    """A summary that is merged where the rows already lie, never sent through the driver.

    It grows with keys and segments, and the size of a compressed file would not tell its own.
    """
    return summary.hint("merge")


def carry(
    df: DataFrame,
    keys: Sequence[str],
    segment: Column | None,
    order: Sequence[str],
    *specs: Carry,
    sparse: bool = False,
) -> DataFrame:
    """Add the column of each spec. ``segment`` must be monotone in ``order`` within a key; None
    scans each key as a whole, for keys that are counted and small.

    ``sparse`` says that few rows hold a value: only those are summarised, beside a plain list of
    the segments of all rows, which needs no sorting aggregate.
    """
    part = [*keys, _SEG] if segment is not None else list(keys)
    marked = df.withColumn(_SEG, segment) if segment is not None else df
    position = F.struct(*order)
    near, edges, carried = marked, [], []
    for n, s in enumerate(specs):
        step = [F.col(c).desc() if s.backward else F.col(c).asc() for c in order]
        local = Window.partitionBy(*part).orderBy(*step)
        local = local.rowsBetween(Window.unboundedPreceding, 0 if s.include_current else -1)
        near = near.withColumn(f"_near{n}", F.last(s.value, ignorenulls=True).over(local))
        if segment is None:
            continue

        at = F.when(F.col(s.value).isNotNull(), position)
        edge = F.min_by(s.value, at) if s.backward else F.max_by(s.value, at)
        edges.append(edge.alias(f"_edge{n}"))

        seg_step = F.col(_SEG).desc() if s.backward else F.col(_SEG).asc()
        across = Window.partitionBy(*keys).orderBy(seg_step)
        across = across.rowsBetween(Window.unboundedPreceding, -1)
        carried.append(F.last(f"_edge{n}", ignorenulls=True).over(across).alias(f"_carried{n}"))
    if segment is None:
        outs = [F.col(f"_near{n}").alias(s.out) for n, s in enumerate(specs)]
        return near.select(*df.columns, *outs)
    if sparse:
        held = marked.where(reduce(or_, [F.col(s.value).isNotNull() for s in specs]))
        places = marked.select(*part).distinct()
        summary = places.join(_beside(held.groupBy(*part).agg(*edges)), part, "left")
    else:
        summary = marked.groupBy(*part).agg(*edges)
    summary = summary.select(*part, *carried)
    joined = near.join(_beside(summary), part, "left")
    outs = [F.coalesce(f"_near{n}", f"_carried{n}").alias(s.out) for n, s in enumerate(specs)]
    return joined.select(*df.columns, *outs)


def running_total(
    df: DataFrame,
    keys: Sequence[str],
    segment: Column,
    order: Sequence[str],
    value: Column,
    out: str,
    total: str | None = None,
) -> DataFrame:
    """Add the running sum of ``value`` in ``order`` and, if named, the key's total."""
    part = [*keys, _SEG]
    marked = df.withColumn(_SEG, segment).withColumn("_rt_value", value)
    local = Window.partitionBy(*part).orderBy(*order)
    local = local.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    across = Window.partitionBy(*keys)
    earlier = across.orderBy(_SEG).rowsBetween(Window.unboundedPreceding, -1)
    sums = (
        marked.groupBy(*part)
        .agg(F.sum("_rt_value").alias("_rt_sum"))
        .select(
            *part,
            F.coalesce(F.sum("_rt_sum").over(earlier), F.lit(0)).alias("_rt_before"),
            F.sum("_rt_sum").over(across).alias("_rt_total"),
        )
    )
    joined = marked.withColumn("_rt_here", F.sum("_rt_value").over(local)).join(_beside(sums), part)
    joined = joined.withColumn(out, F.col("_rt_here") + F.col("_rt_before"))
    if total:
        joined = joined.withColumn(total, F.col("_rt_total"))
    return joined.drop("_rt_value", "_rt_here", "_rt_before", "_rt_total", _SEG)


def magnitude(value: Column) -> Column:
    """Segment of a non-negative integer by its leading eleven bits: narrow ranges where values are
    small and many, and never more than about a thousand segments for each doubling."""
    bits = F.length(F.bin(value))
    top = F.call_function("shiftright", value, F.greatest(bits - 10, F.lit(0)))
    return bits * 1024 + top


def row_numbers(
    df: DataFrame,
    segment: Column,
    order: Sequence[str],
    out: str,
    total: str | None = None,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Consecutive numbers over the whole set without a single-task window."""
    return running_total(df, keys, segment, order, F.lit(1).cast("bigint"), out, total)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One row per key, the first in ``order``.

    Spark keeps at most one row per key and map task before the shuffle, so a hot key stays
    cheap.
    """
    return first_n_per_key(df, keys, order, 1)


def first_n_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column | str],
    n: int,
    rank: str | None = None,
) -> DataFrame:
    name = rank or "_rank"
    numbered = df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    kept = numbered.where(F.col(name) <= n)
    return kept if rank else kept.drop(name)
