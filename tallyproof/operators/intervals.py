"""State histories and the order-aware lookup of the state in force at an event."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyproof.operators.ordered import Carry, carry
from tallyproof.sources.tables import frozen_relation

# Points per entity up to which one entity's history is cheap to test against each of its events.
RANGE_JOIN_POINTS = 64
# Facts and points of one entity up to which its history is scanned as a whole, without segments.
WHOLE_ENTITY_ROWS = 1 << 18


def state_points(
    entities: DataFrame,
    changes: DataFrame,
    key: str,
    order: Sequence[str],
    created: Sequence[str],
    attributes: Sequence[str],
    initial: dict[str, Column],
) -> DataFrame:
    """Change events of known entities plus one synthetic initial state per entity.

    ``created`` are the entity's own order columns, ``attributes`` travel with every point and
    ``initial`` holds the state before the first change.
    """
    start = entities.select(
        key,
        *attributes,
        *[F.col(c).alias(o) for c, o in zip(created, order, strict=True)],
        *[value.alias(name) for name, value in initial.items()],
    )
    kept = changes.select(key, *order, *initial.keys())
    later = kept.join(entities.select(key, *attributes), key)
    return start.unionByName(later)


def state_intervals(
    points: DataFrame, keys: Sequence[str], order: Sequence[str], segment: Column | None = None
) -> DataFrame:
    """Half-open intervals: each point with the order columns of the next one.

    Give a ``segment`` when one entity may hold a large share of the points.
    """
    if segment is None:
        step = Window.partitionBy(*keys).orderBy(*order)
        ahead = [F.lead(c).over(step).alias(f"next_{c}") for c in order]
        return points.select("*", *ahead)
    marked = points.withColumn("_point", F.struct(*order))
    ahead_of = Carry("_point", "_next", backward=True, include_current=False)
    nxt = carry(marked, keys, segment, order, ahead_of)
    ahead = [F.col("_next")[c].alias(f"next_{c}") for c in order]
    return nxt.select(*points.columns, *ahead)


def _after(left: Sequence[Column], right: Sequence[Column]) -> Column:
    """Lexicographic ``left > right``."""
    cond = left[-1] > right[-1]
    for lo, hi in zip(reversed(left[:-1]), reversed(right[:-1]), strict=True):
        cond = (lo > hi) | ((lo == hi) & cond)
    return cond


def range_lookup(
    facts: DataFrame, intervals: DataFrame, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """Equality on the entity plus a residual order test, strict at both ends."""
    f, i = facts.alias("f"), intervals.alias("i")
    at = [F.col(f"f.{c}") for c in order]
    low = [F.col(f"i.{c}") for c in order]
    high = [F.col(f"i.next_{c}") for c in order]
    cond = _after(at, low) & (high[0].isNull() | _after(high, at))
    for key in keys:
        cond = cond & (F.col(f"f.{key}") == F.col(f"i.{key}"))
    bounds = {*keys, *order, *[f"next_{c}" for c in order]}
    state = [F.col(f"i.{c}") for c in intervals.columns if c not in bounds]
    return f.join(i, cond).select("f.*", *state)


def fill_lookup(
    facts: DataFrame,
    points: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    segment: Column | None,
) -> DataFrame:
    """Carries the last state point forward to each fact.

    Rows move once, by entity and segment (by entity alone if ``segment`` is None), and each is
    read once, whatever the number of points. A fact exactly at a point belongs to no interval and drops, as does a fact with no
    point before it.
    """
    state = [c for c in points.columns if c not in {*keys, *order}]
    as_point = points.select(
        *keys, *order, F.struct(*order, *state).alias("_state"), F.lit(0).alias("_kind")
    )
    # Facts keep their own columns, so unused ones are still pruned at the scan.
    mixed = facts.withColumn("_kind", F.lit(1)).unionByName(as_point, allowMissingColumns=True)
    filled = carry(
        mixed, keys, segment, [*order, "_kind"], Carry("_state", "_in_force"), sparse=True
    )
    tie = F.lit(True)
    for c in order:
        tie = tie & (F.col(c) == F.col("_in_force")[c])
    kept = filled.where((F.col("_kind") == 1) & F.col("_in_force").isNotNull() & ~tie)
    return kept.select(
        *facts.columns, *[F.col("_in_force")[c].alias(c) for c in state]
    )


def one_point_each(points: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One point per entity and place: the greatest of those that tie."""
    place = [*keys, *order]
    state = [c for c in points.columns if c not in place]
    if not state:
        return points.distinct()
    merged = points.groupBy(*place).agg(F.max(F.struct(*state)).alias("_state"))
    return merged.select(*[F.col(c) if c in place else F.col("_state")[c].alias(c) for c in points.columns])


def busiest_entity_points(points: DataFrame, keys: Sequence[str]) -> int:
    """The largest number of points, or of other rows, of one entity."""
    row = points.groupBy(*keys).count().agg(F.max("count")).first()
    return int(row[0] or 0)


def interval_lookup(
    facts: DataFrame,
    points: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    segment: Column,
    strategy: str = "auto",
    sized_by: DataFrame | None = None,
) -> DataFrame:
    """State in force strictly after one point and strictly before the next.

    Of several points of one entity at one place the greatest state counts, so the result does not
    depend on the order of the input. ``auto`` counts the points per entity first: short histories use the range join, which
    Spark broadcasts below its size threshold, so the facts need not move; long histories use
    the forward fill. The points are stored, as every way reads them more than once.

    ``sized_by`` holds the facts' keys, cheap to read. With it the rows per entity are counted, and
    while the busiest entity has few, the fill needs no segments and no summary of them.
    """
    points = frozen_relation(one_point_each(points, keys, order), "points")
    most = 0
    if strategy == "auto" or sized_by is not None:
        most = busiest_entity_points(points, keys)
    if strategy == "auto":
        strategy = "range" if most <= RANGE_JOIN_POINTS else "fill"
    if strategy == "range":
        return range_lookup(facts, state_intervals(points, keys, order), keys, order)
    if strategy == "fill":
        if sized_by is not None:
            most += busiest_entity_points(sized_by, keys)
            segment = None if most <= WHOLE_ENTITY_ROWS else segment
        return fill_lookup(facts, points, keys, order, segment)
    raise ValueError(f"unknown strategy {strategy!r}")


def candidate_entities(
    dimension: DataFrame, facts: DataFrame, key: str, fact_key: str | None = None
) -> DataFrame:
    """Dimension or history rows of entities that occur in the selected facts."""
    seen = facts.select(F.col(fact_key or key).alias(key)).distinct()
    return dimension.join(seen, key, "left_semi")
