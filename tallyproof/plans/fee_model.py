"""Trade-level fee and revenue model, its repair policy and the regression proof."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyproof.functions.decimals import USD, exact_decimals, six_dp, usd
from tallyproof.functions.formulas import (
    MATERIAL,
    ORDINARY,
    fee_from_ppm,
    percent_difference,
    reason_code_strict,
    revenue_from_divisor,
    side_selector,
)
from tallyproof.operators.enrich import accepted_repairs, inline_repairs, valued_rows
from tallyproof.operators.intervals import interval_lookup, state_points
from tallyproof.operators.ordered import row_numbers
from tallyproof.operators.reconcile import beside
from tallyproof.sources.scans import prices_of_window
from tallyproof.sources.tables import frozen_relation

ORDER = ["block_number", "evt_index"]
LEGACY, REPAIRED = "legacy", "repaired"

# The published trade row, in order.
TRADE_COLUMNS = [
    "blockchain", "project", "version", "block_date", "block_time", "block_number", "tx_hash",
    "evt_index", "pool", "token_sold", "source_amount_usd", "fee_base_usd", "is_repaired",
    "reason_code", "fee_tier", "fee_divisor", "fees_usd", "revenue_usd", "supply_side_fees_usd",
]


def fee_points(pools: DataFrame, settings: DataFrame, tag: list[str] | None = None) -> DataFrame:
    """Protocol fee state of every pool, off until the first setting."""
    tag = tag or []
    off = {name: F.lit(0).cast("int") for name in ("feeprotocol0", "feeprotocol1")}
    if not tag:
        return state_points(
            pools, settings, "pool", ORDER, ["created_block_number", "created_evt_index"],
            ["token0", "token1", "fee_tier"], off,
        )
    attributes = ["token0", "token1", "fee_tier"]
    start = pools.select(
        *tag, "pool", *attributes,
        F.col("created_block_number").alias("block_number"),
        F.col("created_evt_index").alias("evt_index"),
        *[value.alias(name) for name, value in off.items()],
    )
    later = settings.join(pools.select(*tag, "pool", *attributes), "pool")
    return start.unionByName(later.select(*start.columns))


def fee_columns(rows: DataFrame) -> DataFrame:
    """Divisor, fees, revenue and supply side of rows that carry base, tier and fee state."""
    divisor = side_selector(
        F.col("token_sold"), F.col("token0"), F.col("token1"),
        F.col("feeprotocol0"), F.col("feeprotocol1"),
    )
    with exact_decimals(rows.sparkSession):
        fees = rows.withColumn("fee_divisor", divisor).withColumn(
            "fees_usd", fee_from_ppm(F.col("fee_base_usd"), F.col("fee_tier"))
        )
    # Division keeps 18 places under the default rule and rounds once.
    revenue = fees.withColumn(
        "revenue_usd", revenue_from_divisor(F.col("fees_usd"), F.col("fee_divisor"))
    )
    return supply_side_rows(revenue)


def supply_side_rows(rows: DataFrame) -> DataFrame:
    with exact_decimals(rows.sparkSession):
        return rows.withColumn(
            "supply_side_fees_usd", usd(usd(F.col("fees_usd")) - usd(F.col("revenue_usd")))
        )


def fee_rows(
    trades: DataFrame,
    pools: DataFrame,
    settings: DataFrame,
    prices: DataFrame,
    repair_scope: Column,
    segment: Column,
    grain: str = "minute",
    strategy: str = "auto",
    tag: list[str] | None = None,
    window: tuple[datetime, datetime] | None = None,
) -> DataFrame:
    """The published trade rows. ``window`` is that of the trades; it bounds the price scan.

    Plan: only rows in the repair scope meet the price table; the state lookup is the one step
    that may move all trades, and it does so at most once.
    """
    if window:
        prices = prices_of_window(prices, *window, grain)
    based = inline_repairs(trades, prices, repair_scope, grain)
    points = fee_points(pools, settings, tag)
    keys = [*(tag or []), "pool"]
    # repairs add and drop no row, so the trades tell how many facts an entity has
    stated = interval_lookup(based, points, keys, ORDER, segment, strategy, sized_by=trades)
    rows = fee_columns(stated.withColumnRenamed("amount_usd", "source_amount_usd"))
    return rows.select(*(tag or []), *TRADE_COLUMNS)


def metric_columns() -> dict[str, Column]:
    """One definition of the rollup for totals, dates and paths; rounding follows the sum."""
    fees, revenue = F.sum("fees_usd"), F.sum("revenue_usd")
    supply = usd(fees - revenue)
    return {
        "trade_rows": F.count("*"),
        "repaired_rows": F.count_if("is_repaired"),
        "ordinary_repaired_rows": F.count_if(F.col("reason_code") == ORDINARY),
        "material_repaired_rows": F.count_if(F.col("reason_code") == MATERIAL),
        "unpriced_fee_base_rows": F.count_if(F.col("fee_base_usd").isNull()),
        "repaired_null_rows": F.count_if(F.col("is_repaired") & F.col("fee_base_usd").isNull()),
        "fees_usd": six_dp(fees),
        "supply_side_fees_usd": six_dp(supply),
        "revenue_usd": six_dp(revenue),
        "accounting_residual_usd": six_dp(usd(usd(fees - supply) - revenue)),
    }


def metric_rollup(rows: DataFrame, by: list[str] | None = None) -> DataFrame:
    # Without the rule a difference of two 18-place sums would lose its last place.
    with exact_decimals(rows.sparkSession):
        aggs = [c.alias(name) for name, c in metric_columns().items()]
        return rows.groupBy(*(by or [])).agg(*aggs)


def fee_model(*args: object, **kwargs: object) -> DataFrame:
    """Fees, revenue and supply side of a window with accepted repairs applied, as one row."""
    return metric_rollup(fee_rows(*args, **kwargs))


def repair_impact(
    trades: DataFrame,
    pools: DataFrame,
    settings: DataFrame,
    prices: DataFrame,
    repair_scope: Column,
    segment: Column,
    grain: str = "minute",
) -> DataFrame:
    """The rollup without and with repairs, one row per ``variant``.

    Both bases ride on the row through one price join and one state lookup; only then is a row
    split into its two variants, which meet in one aggregate.
    """
    based = inline_repairs(trades, prices, repair_scope, grain)
    stated = interval_lookup(
        based, fee_points(pools, settings), ["pool"], ORDER, segment, sized_by=trades
    )

    def variant(name: str, base: Column, repaired: Column, reason: Column) -> Column:
        return F.struct(
            F.lit(name).alias("variant"), base.cast(USD).alias("fee_base_usd"),
            repaired.alias("is_repaired"), reason.alias("reason_code"),
        )

    both = F.array(
        variant(LEGACY, usd(F.col("amount_usd")), F.lit(False), F.lit(None).cast("string")),
        variant(REPAIRED, F.col("fee_base_usd"), F.col("is_repaired"), F.col("reason_code")),
    )
    state = ["token_sold", "token0", "token1", "feeprotocol0", "feeprotocol1", "fee_tier"]
    rows = stated.select(*state, F.inline(both))
    total = metric_rollup(fee_columns(rows), ["variant"])
    shown = F.col("fees_usd") - F.col("supply_side_fees_usd") - F.col("revenue_usd")
    return total.withColumn("display_rounding_residual_usd", six_dp(shown))


def affected_rows(
    trades: DataFrame,
    prices: DataFrame,
    repair_scope: Column,
    segment: Column,
    grain: str = "minute",
    window: tuple[datetime, datetime] | None = None,
) -> DataFrame:
    """Every row whose fee base changes, numbered in event order; ``window`` as in ``fee_rows``."""
    if window:
        prices = prices_of_window(prices, *window, grain)
    repairs = accepted_repairs(valued_rows(trades.where(repair_scope), prices, grain))
    legacy, fixed = F.col("legacy_fee_base_usd"), F.col("fixed_fee_base_usd")
    shown = repairs.select(
        "block_date", "block_number", "tx_hash", "evt_index", "pool", "token_sold", "token_bought",
        usd(F.col("token_sold_amount")).alias("token_sold_amount"),
        usd(F.col("token_bought_amount")).alias("token_bought_amount"),
        usd(F.col("input_price")).alias("input_token_price_usd"),
        six_dp(legacy).alias("legacy_fee_base_usd_6"),
        six_dp(fixed).alias("fixed_fee_base_usd_6"),
        percent_difference(legacy, fixed).alias("_pct"),
        "reason_code",
    )
    # Numbering reads the set twice; the stored copy spares a second pass over the trades.
    numbered = numbered_affected(frozen_relation(shown, "repairs"), segment)
    delta = F.col("fixed_fee_base_usd_6") - F.col("legacy_fee_base_usd_6")
    return numbered.withColumn("fee_base_delta_usd", delta.cast("decimal(38,6)")).withColumn(
        "absolute_difference_pct", F.round("_pct", 4).cast("decimal(38,4)")
    ).drop("_pct")


def numbered_affected(rows: DataFrame, segment: Column) -> DataFrame:
    order = ["block_number", "evt_index", "tx_hash"]
    return row_numbers(rows, segment, order, "affected_row_number", "affected_row_count")


def actual_changed(
    trades: DataFrame, prices: DataFrame, repair_scope: Column, grain: str = "minute"
) -> DataFrame:
    """The strict policy: both values present and different at six places."""
    valued = valued_rows(trades.where(repair_scope), prices, grain)
    legacy, fixed = six_dp(F.col("legacy_fee_base_usd")), six_dp(F.col("fixed_fee_base_usd"))
    return valued.where(legacy != fixed).select(
        "block_number", "tx_hash", "evt_index",
        legacy.alias("legacy_fee_base_usd_6"),
        fixed.alias("fixed_fee_base_usd_6"),
        reason_code_strict(
            F.col("legacy_fee_base_usd"), F.col("fixed_fee_base_usd")
        ).alias("reason_code"),
    )


def state_event_partition(pools: DataFrame, settings: DataFrame) -> DataFrame:
    """Entities by number of state events, with duplicate and orphan counts and a residual."""
    per_event = settings.groupBy("pool", *ORDER).agg(F.count("*").alias("n"))
    per_pool = per_event.groupBy("pool").agg(
        F.sum("n").alias("events"), F.sum(F.col("n") - 1).alias("surplus")
    )
    rows = pools.select("pool", F.lit(True).alias("known")).join(per_pool, "pool", "full_outer")
    known, events = F.col("known").isNotNull(), F.coalesce("events", F.lit(0))
    groups = [F.count_if(known & (events == 0)), F.count_if(known & (events == 1)),
              F.count_if(known & (events > 1))]
    entities = pools.agg(F.count_distinct("pool").alias("_entities"))
    totals = rows.agg(
        groups[0].alias("zero_event_entities"),
        groups[1].alias("one_event_entities"),
        groups[2].alias("multiple_event_entities"),
        F.sum(events).alias("state_events"),
        F.coalesce(F.sum("surplus"), F.lit(0)).alias("duplicate_event_surplus"),
        F.count_if(~known).alias("orphan_entities"),
        (groups[0] + groups[1] + groups[2]).alias("_placed"),
    )
    return beside(totals, entities).withColumn(
        "partition_residual", F.col("_entities") - F.col("_placed")
    ).drop("_entities", "_placed")
