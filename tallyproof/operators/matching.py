"""Mutual best matching of opposite transfers, without listing candidate pairs.

For a tolerance an event accepts a contiguous range of opposite amounts. That range is a union
of a few power-of-two blocks of the number line, and every amount lies in one block per size.
Keyed by block, the nearest opposite event in time is a lookup in an ordered scan, so the work
grows with events times the logarithm of the range, however many events one pair has.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyproof.functions.decimals import whole
from tallyproof.operators.ordered import Carry, carry
from tallyproof.sources.tables import frozen_relation

PAIR = ["token", "low", "high"]
# Total order of events, also their identity within a pair.
EVENT = ["block_number", "tx_index", "tx_hash", "evt_index"]
DAY = 86_400

# The published grid of windows and tolerances.
WINDOWS = {
    "5 minutes": timedelta(minutes=5),
    "1 hour": timedelta(hours=1),
    "6 hours": timedelta(hours=6),
    "24 hours": timedelta(hours=24),
    "7 days": timedelta(days=7),
}
TOLERANCES = [0, 10, 100, 500]


def pair_events(transfers: DataFrame, edges: DataFrame) -> DataFrame:
    """Events of pairs that have both directions, with time in seconds.

    Amounts are 64-bit integers, which holds 9.2e12 units of a six-decimal token; larger ones raise.
    """
    rows = transfers.select(
        "token",
        F.least("sender", "receiver").alias("low"),
        F.greatest("sender", "receiver").alias("high"),
        (F.col("sender") > F.col("receiver")).cast("int").alias("direction"),
        F.unix_seconds(F.col("block_time").cast("timestamp")).alias("at"),
        F.col("value").cast("bigint").alias("amount"),
        F.struct(*EVENT).alias("event"),
    )
    return rows.join(edges.select(*PAIR), PAIR, "left_semi")


def _lowest(amount: Column, bps: Column) -> Column:
    """Smallest opposite amount whose difference is within ``bps`` of the larger amount."""
    return F.ceil(whole(amount) * (F.lit(10_000) - bps) / F.lit(10_000)).cast("bigint")


def _highest(amount: Column, bps: Column) -> Column:
    return F.floor(whole(amount) * F.lit(10_000) / (F.lit(10_000) - bps)).cast("bigint")


def _shift(name: str, value: Column, by: Column) -> Column:
    return F.call_function(name, value, by)


def _blocks(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Blocks an event belongs to as a target and blocks its accepted range is made of."""
    bps, amount = F.col("bps"), F.col("amount")
    low, high = _lowest(amount, bps), _highest(amount, bps)
    # The widest range that can contain this amount belongs to its largest admirer.
    widest = _highest(high, bps) - _lowest(high, bps) + 1
    level = F.col("level")
    as_target = events.withColumn(
        "level", F.explode(F.sequence(F.lit(0), F.length(F.bin(widest)) - 1))
    ).select(*PAIR, "bps", "direction", "at", "amount", "event", "level",
             _shift("shiftright", amount, level).alias("block"))

    one = F.lit(1).cast("bigint")
    left = _shift("shiftright", F.col("lo") + _shift("shiftleft", one, level) - 1, level)
    right = _shift("shiftright", F.col("hi") + 1, level)
    spans = (
        events.withColumn("lo", low)
        .withColumn("hi", high)
        .withColumn(
            "level", F.explode(F.sequence(F.lit(0), F.length(F.bin(F.col("hi") - F.col("lo") + 1))))
        )
        .withColumn("left", left)
        .withColumn("right", right)
        .where(F.col("left") < F.col("right"))
    )
    chosen = F.array(
        F.when(F.col("left") % 2 == 1, F.col("left")),
        F.when(F.col("right") % 2 == 1, F.col("right") - 1),
    )
    as_query = (
        spans.withColumn("block", F.explode(chosen))
        .where(F.col("block").isNotNull())
        .select(*PAIR, "bps", (1 - F.col("direction")).alias("direction"), "at", "amount", "event",
                "level", "block")
    )
    return as_target, as_query


def _nearest_gap(events: DataFrame, segment_seconds: int) -> DataFrame:
    """Per event and tolerance the smallest time gap to an acceptable opposite event."""
    as_target, as_query = _blocks(events)
    kind = F.lit(0)
    mixed = as_target.select(
        *PAIR, "bps", "direction", "level", "block", "at", kind.alias("kind"),
        F.col("at").alias("seen"), F.lit(None).cast(events.schema["event"].dataType).alias("event"),
        F.lit(None).cast("bigint").alias("amount"),
    ).unionByName(
        as_query.select(
            *PAIR, "bps", "direction", "level", "block", "at", F.lit(1).alias("kind"),
            F.lit(None).cast("bigint").alias("seen"), "event", "amount",
        )
    )
    keys = [*PAIR, "bps", "direction", "level", "block"]
    segment = F.floor(F.col("at") / segment_seconds)
    # The scan reads its input twice, so the exploded blocks are stored. Targets sort before
    # queries, so an equal time is found looking back.
    near = carry(
        frozen_relation(mixed, "blocks"), keys, segment, ["at", "kind"],
        Carry("seen", "before"), Carry("seen", "after", backward=True),
    )
    gap = F.least(F.col("at") - F.col("before"), F.col("after") - F.col("at"))
    return (
        near.where(F.col("kind") == 1)
        .groupBy(*PAIR, "bps", "direction", "at", "amount", "event")
        .agg(F.min(gap).alias("gap"))
        .where(F.col("gap").isNotNull())
    )


def best_reverse(
    events: DataFrame, widest: timedelta, segment_seconds: int = DAY
) -> DataFrame:
    """Each event's closest opposite event within the window and its tolerance ``bps``.

    Closest means the smallest time gap, in either direction of time; then the smallest raw
    difference; then event order.
    """
    limit = int(widest.total_seconds())
    near_enough = _nearest_gap(events, segment_seconds).where(F.col("gap") <= limit)
    # The second lookup reads its input twice.
    gaps = frozen_relation(near_enough, "gaps")
    # At a known gap only two instants matter; equal amounts at one instant collapse first.
    instants = F.array_distinct(
        F.array(F.col("at") - F.col("gap"), F.col("at") + F.col("gap"))
    )
    asked = gaps.withColumn("instant", F.explode(instants))
    offered = (
        events.select(*PAIR, "direction", F.col("at").alias("instant"), "amount", "event")
        .groupBy(*PAIR, "direction", "instant", "amount")
        .agg(F.min("event").alias("first"))
    )
    offer = F.struct("amount", "first")
    mixed = offered.select(
        *PAIR, "direction", "instant", "amount", F.lit(0).alias("kind"), offer.alias("offer")
    ).unionByName(
        asked.select(
            *PAIR, "direction", "instant", "amount", F.lit(1).alias("kind"),
            F.struct("event", "bps", "gap").alias("ask"),
        ),
        allowMissingColumns=True,
    )
    segment = _shift("shiftright", F.col("amount"), F.lit(24))
    near = carry(
        mixed, [*PAIR, "direction", "instant"], segment, ["amount", "kind"],
        Carry("offer", "below"), Carry("offer", "above", backward=True),
    ).where(F.col("kind") == 1)
    found = (
        near.withColumn("hit", F.explode(F.array("below", "above")))
        .where(F.col("hit").isNotNull())
        .withColumn("difference", F.abs(F.col("amount") - F.col("hit.amount")))
        .where(
            whole(F.col("difference")) * 10_000
            <= whole(F.greatest("amount", "hit.amount")) * F.col("ask.bps")
        )
    )
    return (
        found.groupBy(
            *PAIR, F.col("ask.bps").alias("bps"), (1 - F.col("direction")).alias("direction"),
            F.col("ask.event").alias("event"),
        )
        .agg(
            F.min(F.struct("difference", F.col("hit.first").alias("pick"))).alias("m"),
            F.min("ask.gap").alias("gap"),
        )
        .select(*PAIR, "bps", "direction", "event", F.col("m.pick").alias("pick"),
                F.col("m.difference").alias("difference"), "gap")
    )


def mutual_best_match(
    events: DataFrame,
    tolerances: Sequence[int],
    widest: timedelta,
    segment_seconds: int = DAY,
) -> DataFrame:
    """Pairs of events that choose each other, per tolerance.

    Events of one direction, instant and amount make the same choice, and only the first of them
    can be chosen, so equal events collapse before anything else. Both sides of a choice are
    written in the same order and counted, which replaces a self join.
    """
    levels = F.array(*[F.lit(b) for b in tolerances])
    first = events.groupBy(*PAIR, "direction", "at", "amount").agg(F.min("event").alias("event"))
    tried = frozen_relation(first, "instants").withColumn("bps", F.explode(levels))
    best = best_reverse(tried, widest, segment_seconds)
    ahead = F.col("direction") == 0
    return (
        best.groupBy(
            *PAIR, "bps",
            F.when(ahead, F.col("event")).otherwise(F.col("pick")).alias("forward"),
            F.when(ahead, F.col("pick")).otherwise(F.col("event")).alias("reverse"),
        )
        .agg(F.count("*").alias("n"), F.min("gap").alias("gap_seconds"),
             F.min("difference").alias("raw_difference"))
        .where(F.col("n") == 2)
        .drop("n")
    )


def return_grid(
    matches: DataFrame, tolerances: Sequence[int], windows: dict[str, timedelta]
) -> DataFrame:
    """Matched pairs, events and largest gap per window and tolerance; screening only.

    An event's closest match does not depend on the window once it is inside, so the widest
    window is matched once and each cell counts the pairs within its own limit.
    """
    cells = F.array(
        *[
            F.struct(F.lit(n).alias("name"), F.lit(int(w.total_seconds())).alias("seconds"))
            for n, w in windows.items()
        ]
    )
    levels = matches.sparkSession.createDataFrame([(b,) for b in tolerances], "bps int")
    grid = levels.withColumn("cell", F.explode(cells))
    counted = (
        matches.groupBy("bps", "gap_seconds")
        .agg(F.count("*").alias("n"))
        .withColumn("cell", F.explode(cells))
        .where(F.col("gap_seconds") <= F.col("cell.seconds"))
        .groupBy("bps", "cell")
        .agg(F.sum("n").alias("n"), F.max("gap_seconds").alias("gap"))
    )
    return grid.join(counted, ["bps", "cell"], "left").select(
        F.col("cell.name").alias("time_window"),
        F.col("bps").alias("tolerance_bps"),
        F.coalesce("n", F.lit(0)).alias("matched_pairs"),
        (F.coalesce("n", F.lit(0)) * 2).alias("matched_events"),
        F.col("gap").alias("largest_gap_seconds"),
    )

