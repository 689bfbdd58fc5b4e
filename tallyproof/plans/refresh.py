"""Incremental maintenance by date partition: bounds, refresh, backfill and health."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date, datetime, time, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyproof.functions.decimals import exact_decimals, six_dp, usd
from tallyproof.operators.digests import differing, range_digests
from tallyproof.operators.intervals import candidate_entities
from tallyproof.plans.fee_model import TRADE_COLUMNS, fee_rows
from tallyproof.sources.scans import prices_of_window
from tallyproof.sources.tables import (
    PARTITION,
    frozen_relation,
    held_dates,
    newest_date,
    replace_partitions,
    trade_sink,
)

# Fixed value: an incremental run recomputes the latest three UTC dates.
OVERLAP_DAYS = 2


@dataclass(frozen=True)
class Bounds:
    """Half-open range of dates a run recomputes."""

    mode: str
    start: date
    end: date

    def on(self, column: str = PARTITION) -> Column:
        day = F.col(column)
        return (day >= F.lit(self.start)) & (day < F.lit(self.end))


@dataclass(frozen=True)
class Dates:
    """Single dates a run recomputes; ``start`` and ``end`` enclose them for side scans."""

    days: tuple[date, ...]

    @property
    def start(self) -> date:
        return min(self.days)

    @property
    def end(self) -> date:
        return max(self.days) + timedelta(days=1)

    def on(self, column: str = PARTITION) -> Column:
        return F.col(column).isin(list(self.days))


def refresh_bounds(
    model_start: date,
    today: date,
    model_end: date | None = None,
    newest: date | None = None,
    backfill: tuple[date | None, date | None] = (None, None),
    incremental: bool = True,
) -> Bounds:
    """Dates of this run. ``today`` is passed in, so a rerun is reproducible."""
    first, last = backfill
    if (first is None) != (last is None):
        raise ValueError("a backfill needs both its start and its end date")
    end = model_end or today
    if not incremental:
        return Bounds("full", model_start, end)
    if first is not None:
        return Bounds("backfill", max(first, model_start), min(last, end))
    since = newest - timedelta(days=OVERLAP_DAYS) if newest else model_start
    return Bounds("incremental", max(since, model_start), end)


Build = Callable[[Bounds | Dates], DataFrame]


def full_refresh(path: str, build: Build, bounds: Bounds) -> None:
    """Rebuild every date, as after a change of the model's logic."""
    trade_sink(build(bounds), path, TRADE_COLUMNS)


def incremental_refresh(
    spark: SparkSession, path: str, build: Build, model_start: date, today: date
) -> Bounds:
    """Recompute the overlap dates; an empty target starts at the model start."""
    bounds = refresh_bounds(model_start, today, newest=newest_date(spark, path))
    replace_partitions(build(bounds).select(*TRADE_COLUMNS), path)
    return bounds


def backfill(
    spark: SparkSession,
    path: str,
    build: Build,
    model_start: date,
    today: date,
    window: tuple[date | None, date | None],
    drop_empty: bool = False,
) -> Bounds:
    """Recompute bounded older dates; optionally drop dates that are now empty, in the same step."""
    bounds = refresh_bounds(model_start, today, backfill=window)
    held = [day for day in held_dates(spark, path) if bounds.start <= day < bounds.end]
    rows = build(bounds).select(*TRADE_COLUMNS)
    # dates that the batch brings are replaced, so only the others of the window are dropped
    replace_partitions(rows, path, drop=held if drop_empty else ())
    return bounds


def input_digests(trades: DataFrame, settings: DataFrame, prices: DataFrame) -> DataFrame:
    """Digest of the model's inputs: trades and prices per date, settings per entity.

    A small table to be kept with the target: the next run compares its inputs with it.
    """
    def of(name: str, rows: DataFrame, part: Column, keys: list[str]) -> DataFrame:
        fields = [c for c in rows.columns if c not in keys]
        return range_digests(rows, part, F.lit(0), keys, fields).withColumn("_input", F.lit(name))

    return (
        of("trades", trades, F.col(PARTITION), ["tx_hash", "evt_index"])
        .unionByName(of("prices", prices, F.to_date("bucket"), ["asset", "bucket"]))
        .unionByName(of("settings", settings, F.col("pool"), ["pool", "block_number", "evt_index"]))
    )


def changed_dates(before: DataFrame, after: DataFrame, trades: DataFrame) -> list[date]:
    """Dates whose rows may differ under changed inputs: those of changed trades and prices, and
    those on which an entity with changed settings traded. One entry per date."""
    changed = frozen_relation(differing(before, after, ["_input", "_part"]), "changed")
    direct = changed.where("_input <> 'settings'").select(F.col("_part").cast("date").alias("d"))
    entities = changed.where("_input = 'settings'").select(F.col("_part").alias("_entity"))
    moved = trades.join(entities, F.col("pool").cast("string") == F.col("_entity"), "left_semi")
    every = direct.unionByName(moved.select(F.col(PARTITION).alias("d"))).distinct()
    return sorted(row.d for row in every.where("d IS NOT NULL").collect())


def drift_refresh(
    spark: SparkSession, path: str, build: Build, dates: Sequence[date], bounds: Bounds
) -> list[date]:
    """Recompute exactly the given dates inside ``bounds``, however old, and switch them at once.

    A date that lost all its rows leaves the table. Returns the dates that were recomputed.
    """
    wanted = tuple(day for day in dates if bounds.start <= day < bounds.end)
    if wanted:
        replace_partitions(build(Dates(wanted)).select(*TRADE_COLUMNS), path, drop=wanted)
    return list(wanted)


def incremental_build(
    trades: DataFrame,
    pools: DataFrame,
    settings: DataFrame,
    prices: DataFrame,
    repair_scope: Column,
    segment: Column,
    grain: str = "minute",
) -> Build:
    """The fee model restricted to a run's dates, their prices and entities seen in them."""

    def build(bounds: Bounds | Dates) -> DataFrame:
        selected = trades.where(bounds.on())
        kept_pools = candidate_entities(pools, selected, "pool")
        start, end = (datetime.combine(day, time()) for day in (bounds.start, bounds.end))
        near = prices_of_window(prices, start, end, grain)
        return fee_rows(selected, kept_pools, settings, near, repair_scope, segment, grain)

    return build


def simulate_replacement(full: DataFrame, recomputed: DataFrame, bounds: Bounds) -> DataFrame:
    """Retained old dates plus recomputed dates: what the table holds after a replacement."""
    return full.where(~bounds.on()).unionByName(recomputed.where(bounds.on()))


def refresh_health(
    rows: DataFrame, keys: Sequence[str] = ("tx_hash", "evt_index"), by: str = PARTITION
) -> DataFrame:
    """Per date touched: rows, duplicate keys, unpriced and repaired rows, residual.

    One scan: counting per key first spreads a busy date over its keys.
    """
    per_key = rows.groupBy(by, *keys).agg(
        F.count("*").alias("n"),
        F.count_if("is_repaired").alias("repaired"),
        F.count_if(F.col("fee_base_usd").isNull()).alias("unpriced"),
        *[F.sum(c).alias(c) for c in ("fees_usd", "revenue_usd", "supply_side_fees_usd")],
    )
    residual = usd(F.sum("fees_usd") - F.sum("supply_side_fees_usd")) - F.sum("revenue_usd")
    with exact_decimals(rows.sparkSession):
        return per_key.groupBy(by).agg(
            F.sum("n").alias("trade_rows"),
            F.count("*").alias("distinct_keys"),
            F.sum(F.col("n") - 1).alias("duplicate_surplus_rows"),
            F.sum("repaired").alias("repaired_rows"),
            F.sum("unpriced").alias("unpriced_fee_base_rows"),
            six_dp(usd(residual)).alias("accounting_residual_usd"),
        )


def tagged_paths(paths: dict[str, DataFrame], tag: str = "model_path") -> DataFrame:
    """Variants of one relation in one plan, told apart by a tag."""
    out = None
    for name, df in paths.items():
        part = df.select(F.lit(name).alias(tag), "*")
        out = part if out is None else out.unionByName(part)
    return out
