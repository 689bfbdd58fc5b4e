"""Joins that add prices, metadata, annotations and accepted repairs to event rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyproof.functions.decimals import USD, exact_decimals, six_dp, usd
from tallyproof.functions.formulas import (
    changed_at_six_dp,
    direction_agrees,
    fee_usd,
    input_side_value,
    reason_code_model,
)
from tallyproof.operators.ordered import first_per_key
from tallyproof.operators.sides import BROADCAST_BYTES, sized_side


def bucket_price_join(
    facts: DataFrame,
    prices: DataFrame,
    asset: str,
    ts: str,
    grain: str,
    values: dict[str, str],
) -> DataFrame:
    """LEFT join on asset and truncated time; a missing price stays NULL.

    ``prices`` has one row per ``(asset, bucket)``; ``values`` maps its columns to output
    names. The bucket is part of the key, so one busy asset is spread over many partitions.
    """
    side = prices.select(
        F.col("asset").alias("_asset"),
        F.col("bucket").alias("_bucket"),
        *[F.col(src).alias(name) for src, name in values.items()],
    )
    at = F.date_trunc(grain, F.col(ts))
    cond = (F.col(asset) == F.col("_asset")) & (at == F.col("_bucket"))
    return facts.join(side, cond, "left").drop("_asset", "_bucket")


def minute_price_join(
    facts: DataFrame,
    prices: DataFrame,
    asset: str,
    ts: str,
    values: dict[str, str] | None = None,
    grain: str = "minute",
) -> DataFrame:
    return bucket_price_join(facts, prices, asset, ts, grain, values or {"price": "price"})


def hourly_price_join(
    facts: DataFrame, prices: DataFrame, ts: str, asset: object, price: str = "price"
) -> DataFrame:
    """Hourly price of one asset, such as the gas asset."""
    one = prices.where(F.col("asset") == F.lit(asset)).select(
        F.col("bucket").alias("_bucket"), F.col("price").alias(price)
    )
    cond = F.date_trunc("hour", F.col(ts)) == F.col("_bucket")
    return facts.join(one, cond, "left").drop("_bucket")


def latest_dimension_row(
    versions: DataFrame, keys: Sequence[str], updated: str, tie_break: Sequence[str] = ()
) -> DataFrame:
    """The newest version per key; undated versions lose."""
    return first_per_key(versions, keys, [F.col(updated).desc_nulls_last(), *tie_break])


def role_dim_join(
    facts: DataFrame, dim: DataFrame, key: str, roles: dict[str, str], values: Sequence[str]
) -> DataFrame:
    """Join one dimension once per role; ``roles`` maps a fact column to a name prefix."""
    out = facts
    for column, prefix in roles.items():
        side = dim.select(
            F.col(key).alias("_dim_key"), *[F.col(v).alias(f"{prefix}_{v}") for v in values]
        )
        out = out.join(side, F.col(column) == F.col("_dim_key"), "left").drop("_dim_key")
    return out


def valued_rows(
    trades: DataFrame, prices: DataFrame, grain: str = "minute", asset: str = "token_sold"
) -> DataFrame:
    """Legacy and input-side value of each trade."""
    priced = minute_price_join(
        trades, prices, asset, "block_time", {"price": "input_price"}, grain
    )
    with exact_decimals(trades.sparkSession):
        return priced.withColumn("legacy_fee_base_usd", usd(F.col("amount_usd"))).withColumn(
            "fixed_fee_base_usd",
            input_side_value(F.col("token_sold_amount"), F.col("input_price")),
        )


def accepted_repairs(valued: DataFrame) -> DataFrame:
    """Rows whose input-side value differs from the legacy one at six places."""
    legacy, fixed = F.col("legacy_fee_base_usd"), F.col("fixed_fee_base_usd")
    return valued.where(changed_at_six_dp(legacy, fixed)).withColumn(
        "reason_code", reason_code_model(legacy, fixed)
    )


def repair_overlay(trades: DataFrame, repairs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Put accepted repairs over the trades on the full key.

    Use this for a stored repair set; ``inline_repairs`` gives the same rows from the prices. A
    small set is broadcast, so the trades stay where they are.
    """
    side, _ = sized_side(
        repairs.select(
            *keys,
            F.col("fixed_fee_base_usd").alias("_fixed"),
            "reason_code",
            F.lit(True).alias("_hit"),
        )
    )
    joined = trades.join(side, list(keys), "left")
    return (
        joined.withColumn("fee_base_usd", F.coalesce("_fixed", usd(F.col("amount_usd"))))
        .withColumn("is_repaired", F.coalesce("_hit", F.lit(False)))
        .drop("_fixed", "_hit")
    )


def scoped_prices(
    trades: DataFrame, prices: DataFrame, in_scope: Column, asset: str = "token_sold"
) -> DataFrame:
    """Prices of assets sold in scope; the trades are read for two columns only.

    The assets are stored and, while few, broadcast: so they reach the rows that prices are made
    of, and no price of another asset is aggregated or moved.
    """
    sold = trades.where(in_scope & F.col(asset).isNotNull())
    sold, _ = sized_side(sold.select(F.col(asset).alias("asset")).distinct())
    return prices.select("asset", "bucket", "price").join(sold, "asset", "left_semi")


def inline_repairs(
    trades: DataFrame,
    prices: DataFrame,
    in_scope: Column,
    grain: str = "minute",
    side_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Repair the rows in scope and pass the others through untouched.

    The prices that the scope needs are stored. While they are small, the trades are read once and
    meet a broadcast table. Beyond that the rows in scope are priced by a shuffled
    join of their own and the others are neither joined nor moved.
    """
    scope = F.coalesce(in_scope, F.lit(False))
    side, small = sized_side(scoped_prices(trades, prices, scope), side_bytes)
    if small:
        rows = trades.withColumn("_scope", scope).withColumn(
            "_scope_asset", F.when(F.col("_scope"), F.col("token_sold"))
        )
        valued = valued_rows(rows, side, grain, "_scope_asset")
        return _overlaid(valued, F.col("_scope"), trades.columns)
    valued = valued_rows(trades.where(scope), side, grain)
    rest = trades.where(~scope).withColumn("legacy_fee_base_usd", usd(F.col("amount_usd")))
    rest = rest.withColumn("fixed_fee_base_usd", F.lit(None).cast(USD))
    repaired = _overlaid(valued, F.lit(True), trades.columns)
    return repaired.unionByName(_overlaid(rest, F.lit(False), trades.columns))


def _overlaid(valued: DataFrame, scope: Column, columns: Sequence[str]) -> DataFrame:
    legacy, fixed = F.col("legacy_fee_base_usd"), F.col("fixed_fee_base_usd")
    hit = scope & changed_at_six_dp(legacy, fixed)
    return valued.select(
        *columns,
        F.when(hit, fixed).otherwise(legacy).alias("fee_base_usd"),
        hit.alias("is_repaired"),
        F.when(hit, reason_code_model(legacy, fixed)).alias("reason_code"),
    )


def two_leg_reconcile(
    model: DataFrame, left: DataFrame, right: DataFrame, keys: Sequence[str]
) -> DataFrame:
    """Model rows with both curated legs side by side, prefixed ``left_`` and ``right_``."""
    out = model
    for prefix, leg in (("left", left), ("right", right)):
        side = leg.select(
            *keys,
            F.lit(True).alias(f"{prefix}_found"),
            *[F.col(c).alias(f"{prefix}_{c}") for c in leg.columns if c not in keys],
        )
        out = out.join(side, list(keys), "left").withColumn(
            f"{prefix}_found", F.coalesce(f"{prefix}_found", F.lit(False))
        )
    return out


def annotation_split(rows: DataFrame, listed: DataFrame, column: str, key: str) -> DataFrame:
    """Flag rows whose address is in an annotation list; list duplicates cannot fan out."""
    marks = listed.select(F.col(key).alias("_listed")).distinct()
    joined = rows.join(marks, F.col(column) == F.col("_listed"), "left")
    return joined.withColumn("is_listed", F.col("_listed").isNotNull()).drop("_listed")


def annotation_exclude(rows: DataFrame, listed: DataFrame, column: str, key: str) -> DataFrame:
    """Rows whose address is in no annotation list."""
    marks = listed.select(F.col(key).alias(column))
    return rows.join(marks, column, "left_anti")


def late_annotation(
    cases: DataFrame, labels: DataFrame, listed: DataFrame, key: str, stratum: str
) -> DataFrame:
    """Annotations of already selected cases, counted per stratum.

    The cases are few by selection and counted, so they go to the label tables, which are reduced
    to the cases before anything is grouped.
    """
    chosen = cases.select(key, stratum)
    wanted, _ = sized_side(chosen.select(key))
    label_counts = (
        labels.select(F.col("address").alias(key))
        .join(wanted, key, "left_semi")
        .groupBy(key)
        .agg(F.count("*").alias("_labels"))
    )
    marks = (
        listed.select(F.col("address").alias(key))
        .join(wanted, key, "left_semi")
        .distinct()
        .withColumn("_listed", F.lit(1))
    )
    return (
        chosen.join(label_counts, key, "left")
        .join(marks, key, "left")
        .groupBy(stratum)
        .agg(
            F.count("*").alias("cases"),
            F.count("_labels").alias("labelled_cases"),
            F.coalesce(F.sum("_labels"), F.lit(0)).alias("label_rows"),
            F.count("_listed").alias("listed_cases"),
        )
    )


def two_leg_valuation(trades: DataFrame, prices: DataFrame, grain: str = "minute") -> DataFrame:
    """Value both legs and name the one the source USD follows at six places."""
    sold = minute_price_join(trades, prices, "token_sold", "block_time", {"price": "_ps"}, grain)
    both = minute_price_join(sold, prices, "token_bought", "block_time", {"price": "_pb"}, grain)
    with exact_decimals(trades.sparkSession):
        valued = both.withColumn(
            "sold_usd", input_side_value(F.col("token_sold_amount"), F.col("_ps"))
        ).withColumn("bought_usd", input_side_value(F.col("token_bought_amount"), F.col("_pb")))
    source = six_dp(usd(F.col("amount_usd")))
    on_sold = F.coalesce(source == six_dp(F.col("sold_usd")), F.lit(False))
    on_bought = F.coalesce(source == six_dp(F.col("bought_usd")), F.lit(False))
    leg = (
        F.when(source.isNull(), "UNPRICED")
        .when(on_sold & on_bought, "BOTH")
        .when(on_sold, "SOLD")
        .when(on_bought, "BOUGHT")
        .otherwise("NEITHER")
    )
    return valued.withColumn("matched_leg", leg).drop("_ps", "_pb")


def raw_direction_check(trades: DataFrame, swaps: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Signed raw swap amounts against the decoded trade amounts and direction."""
    side = swaps.select(*keys, "amount0", "amount1")
    entered = F.when(F.col("sold_is_token0"), F.col("amount0")).otherwise(F.col("amount1"))
    left = F.when(F.col("sold_is_token0"), F.col("amount1")).otherwise(F.col("amount0"))
    return (
        trades.join(side, list(keys), "left")
        .withColumn("has_raw", F.col("amount0").isNotNull() & F.col("amount1").isNotNull())
        .withColumn("sold_matches", entered.eqNullSafe(F.col("token_sold_amount_raw")))
        .withColumn("bought_matches", (-left).eqNullSafe(F.col("token_bought_amount_raw")))
        .withColumn(
            "direction_agrees",
            F.coalesce(
                direction_agrees(F.col("amount0"), F.col("amount1"), F.col("sold_is_token0")),
                F.lit(False),
            ),
        )
    )


def priced_fees(transactions: DataFrame, prices: DataFrame, asset: object) -> DataFrame:
    """Transactions with the gas asset's hourly price and the fee in USD."""
    joined = hourly_price_join(transactions, prices, "block_time", asset, "gas_asset_price")
    with exact_decimals(transactions.sparkSession):
        return joined.withColumn("fee_usd", fee_usd(F.col("fee_wei"), F.col("gas_asset_price")))

