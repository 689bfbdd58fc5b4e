"""Scalar formulas as Column functions: fees, revenue, valuation, comparison, transaction cost."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyproof.functions.decimals import (
    BPS,
    RAW,
    USD,
    dec,
    int_div,
    six_dp,
    units_times_price,
    usd,
    whole,
)

# Reason codes written to repaired rows.
ORDINARY = "FEE_BASE_INPUT_SIDE_REVALUATION"
MATERIAL = "FEE_BASE_INPUT_SIDE_REVALUATION_GT_100PCT"

# Price status of a liquidation leg.
PRICED = "PRICED"
MISSING_PRICE = "MISSING_PRICE"

# A protocol fee divisor is active from 4 through 10.
MIN_DIVISOR = 4
MAX_DIVISOR = 10

# Fixed value: token decimals assumed when neither price nor metadata names them.
DEFAULT_DECIMALS = 18


def differs(left: Column, right: Column) -> Column:
    """IS DISTINCT FROM."""
    return ~left.eqNullSafe(right)


def fee_from_ppm(base: Column, tier_ppm: Column) -> Column:
    """``base * tier / 1e6`` at 18 places; an unpriced base pays zero.

    Resolve under ``exact_decimals``. The per-million share is rounded to 18 places before the
    tier is applied, so the result does not depend on the engine's division rule.
    """
    per_million = usd(usd(base) * dec("0.000001", "decimal(6,6)"))
    fee = usd(per_million * tier_ppm.cast("decimal(6,0)"))
    return F.when(base.isNotNull(), fee).otherwise(dec(0, USD))


def revenue_from_divisor(fees: Column, divisor: Column) -> Column:
    """The protocol's share of the fees; zero unless the divisor is active."""
    share = usd(usd(fees) / divisor.cast("decimal(2,0)"))
    active = divisor.between(MIN_DIVISOR, MAX_DIVISOR)
    return F.when(active, share).otherwise(dec(0, USD))


def side_selector(
    sold: Column, token0: Column, token1: Column, state0: Column, state1: Column
) -> Column:
    """State of the side that was sold; NULL when the token is on neither side."""
    return F.when(sold == token0, state0).when(sold == token1, state1)


def input_side_value(amount: Column, price: Column) -> Column:
    """Sold amount times its price; NULL if either is missing. Resolve under ``exact_decimals``.

    The product holds eight integer digits and raises beyond that, as declared operand types
    demand.
    """
    return usd(amount.cast("decimal(30,12)") * price.cast("decimal(24,18)"))


def scale_raw_amount(raw: Column, decimals: Column) -> Column:
    """Raw integer units to token units (DOUBLE); NULL when decimals are unknown."""
    return raw.cast("double") / F.pow(F.lit(10.0), decimals)


def leg_usd(raw: Column, price: Column, price_decimals: Column, token_decimals: Column) -> Column:
    """USD of a leg (DOUBLE); stays NULL without a price."""
    decimals = F.coalesce(price_decimals, token_decimals, F.lit(DEFAULT_DECIMALS))
    value = raw.cast("double") / F.pow(F.lit(10.0), decimals) * price.cast("double")
    return F.when(price.isNotNull(), value)


def price_status(price: Column) -> Column:
    return F.when(price.isNull(), MISSING_PRICE).otherwise(PRICED)


def percent_difference(legacy: Column, fixed: Column) -> Column:
    """Absolute difference in percent of ``fixed`` from unrounded values (DOUBLE)."""
    gap = F.abs(legacy.cast("double") - fixed.cast("double")) / fixed.cast("double") * 100.0
    return F.when((fixed > dec(0, USD)) & legacy.isNotNull(), gap)


def changed_at_six_dp(legacy: Column, fixed: Column) -> Column:
    """Null-safe: a missing legacy value next to a fixed one counts as changed."""
    return fixed.isNotNull() & differs(six_dp(legacy), six_dp(fixed))


def reason_code_model(legacy: Column, fixed: Column) -> Column:
    """The model's rule: percentage from unrounded values."""
    return F.when(percent_difference(legacy, fixed) > 100.0, MATERIAL).otherwise(ORDINARY)


def reason_code_strict(legacy: Column, fixed: Column) -> Column:
    """The regression's rule: compares six-place decimals without a percentage."""
    old, new = six_dp(legacy), six_dp(fixed)
    material = (new != dec(0, "decimal(38,6)")) & (F.abs(old - new) > F.abs(new))
    return F.when(material, MATERIAL).otherwise(ORDINARY)


def base_transfer_filter(
    token: Column,
    sender: Column,
    receiver: Column,
    value: Column,
    tokens: Sequence[object],
    zero_address: object,
) -> Column:
    """Tokens in scope, positive amounts, no zero address, no self transfer."""
    zero = F.lit(zero_address)
    return (
        token.isin(list(tokens))
        & (value > 0)
        & (sender != zero)
        & (receiver != zero)
        & (sender != receiver)
    )


def fee_wei(gas_used: Column, gas_price: Column) -> Column:
    return whole(gas_used.cast("decimal(18,0)") * gas_price.cast("decimal(19,0)"))


def fee_usd(wei: Column, price: Column) -> Column:
    """Wei to USD at 18 places, whatever the price's own scale. Resolve under ``exact_decimals``."""
    return units_times_price(wei, F.lit(18), price)


def _floored_fee(wei: Column, price: Column) -> Column:
    """The fee cut at 18 places: below it by less than the smallest step of a movement, so
    comparisons with a movement and whole quotients by it stay exact."""
    return units_times_price(wei, F.lit(18), price, down=True)


def fee_reaches_movement(wei: Column, price: Column, movement_raw: Column) -> Column:
    """``fee_usd >= movement_raw / 1e6``, exactly; a zero movement is reached by any fee.

    Resolve under ``exact_decimals``.
    """
    moved = movement_raw.cast("decimal(26,0)") * dec("0.000001", "decimal(6,6)")
    return _floored_fee(wei, price) >= moved.cast("decimal(32,6)")


def fee_to_movement_bps(wei: Column, price: Column, movement_raw: Column) -> Column:
    """Whole basis points; NULL for a zero movement. Resolve under ``exact_decimals``."""
    scaled = usd(_floored_fee(wei, price) * dec(10**6 * BPS, "decimal(11,0)"))
    return int_div(F.floor(scaled), movement_raw)


def from_units(raw_sum: Column, decimals: int) -> Column:
    """One exact conversion after an integer aggregate. Resolve under ``exact_decimals``."""
    unit = "0." + "0" * (decimals - 1) + "1"
    return (whole(raw_sum) * dec(unit, f"decimal({decimals},{decimals})")).cast(
        f"decimal(38,{decimals})"
    )


def recomposes(raw_sum: Column, decimals: int) -> Column:
    """Quotient and remainder of the unit rebuild the integer."""
    unit = dec(10**decimals, RAW)
    quotient = F.floor(whole(raw_sum) / unit).cast(RAW)
    remainder = whole(whole(raw_sum) % unit)
    return whole(whole(quotient * unit) + remainder) == whole(raw_sum)


def direction_agrees(amount0: Column, amount1: Column, sold_is_token0: Column) -> Column:
    """The sold token enters the pool (positive), the bought token leaves it (negative)."""
    entered = F.when(sold_is_token0, amount0).otherwise(amount1)
    left = F.when(sold_is_token0, amount1).otherwise(amount0)
    return (entered > 0) & (left < 0)
