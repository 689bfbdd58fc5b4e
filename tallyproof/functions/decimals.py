"""Exact decimal arithmetic.

Spark's default rules drop fractional digits when a product would need more than 38 digits.
Money is therefore computed under ``exact_decimals`` and every intermediate is cast to a
declared type.
"""

from __future__ import annotations

from contextlib import AbstractContextManager
from decimal import Decimal

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from tallyproof.session import session_conf

USD = "decimal(38,18)"
USD6 = "decimal(38,6)"
RAW = "decimal(38,0)"

BPS = 10_000


def exact_decimals(spark: SparkSession) -> AbstractContextManager[None]:
    """Keep all fractional digits of products resolved inside the block.

    The resolved type stays with the expression, so the session is back to the caller's
    setting when the action runs.
    """
    return session_conf(spark, spark__sql__decimalOperations__allowPrecisionLoss="false")


def dec(value: str | int, kind: str) -> Column:
    """A decimal literal of a declared type."""
    return F.lit(Decimal(value)).cast(kind)


def usd(column: Column) -> Column:
    return column.cast(USD)


def six_dp(column: Column) -> Column:
    """Reporting precision: six places, half up."""
    return F.round(column, 6).cast(USD6)


def whole(column: Column) -> Column:
    return column.cast(RAW)


def int_div(numerator: Column, denominator: Column) -> Column:
    """Exact integer quotient; NULL where the denominator is zero."""
    return F.call_function("div", whole(numerator), F.nullif(whole(denominator), dec(0, RAW)))


def quotient(
    numerator: Column, denominator: Column, places: int, scale: int, shift: int = 0
) -> Column:
    """``numerator * 10**shift / denominator`` rounded once, half up, at ``places``; NULL over zero.

    A division of decimals is cut to the places of its type before any rounding, so a second
    rounding can meet a half that the exact value does not reach. Here the whole quotient, its
    digits and what is left over come from integer division, and the remainder alone decides. Both
    sides have at most ``scale`` places and ``36 - places - shift`` digits, the result at most
    ``36 - places`` in all; more raise. It is the same under either decimal rule of the session.
    """
    digits = places + shift
    if not 0 <= digits <= 17:
        raise ValueError(f"{digits} digits of a quotient do not fit into a long")
    kind = f"decimal({36 - digits},{scale})"
    n, d = F.abs(numerator.cast(kind)), F.abs(F.nullif(denominator, F.lit(0)).cast(kind))
    scaled = (n % d).cast(kind) * dec(10**digits, f"decimal({digits + 1},0)")
    rest = scaled % d
    # integer division of decimals gives a long, so the three parts are put together as decimals
    whole_part = F.call_function("div", n, d).cast("decimal(19,0)")
    tail = F.call_function("div", scaled, d) + F.when(rest >= d - rest, 1).otherwise(0)
    value = whole_part * dec(10**digits, f"decimal({digits + 1},0)") + tail.cast("decimal(19,0)")
    value = value.cast(f"decimal({36 - places},0)")
    signed = F.when((numerator < 0) != (denominator < 0), -value).otherwise(value)
    unit = dec(str(Decimal(1).scaleb(-places)), f"decimal({max(places, 1)},{places})")
    return (signed * unit).cast(f"decimal(38,{places})")


def percent(part: Column, total: Column, places: int, scale: int = 0) -> Column:
    """``part`` in percent of ``total``, rounded once at ``places``."""
    return quotient(part, total, places, scale, shift=2)


def bps(part: Column, total: Column) -> Column:
    """``part / total`` in whole basis points, rounded down."""
    return int_div(whole(part) * F.lit(BPS), total)


def reaches(part: Column, total: Column, threshold_bps: Column | int) -> Column:
    """``part / total >= threshold`` without a division."""
    limit = F.lit(threshold_bps) if isinstance(threshold_bps, int) else threshold_bps
    return whole(part) * F.lit(BPS) >= whole(total) * limit


def power_of_ten(exponent: Column) -> Column:
    """Ten to a whole number from 0 to 18 as DECIMAL; other exponents raise."""
    table = F.array(*[dec(10**k, RAW) for k in range(19)])
    outside = F.raise_error(F.concat(F.lit("no exact scale for decimals "), exponent.cast("string")))
    chosen = F.element_at(table, exponent.cast("int") + 1)
    return F.when(exponent.isNull() | exponent.between(0, 18), chosen).otherwise(outside.cast(RAW))


def units_times_price(raw: Column, decimals: Column, price: Column, down: bool = False) -> Column:
    """``raw / 10**decimals * price`` rounded once, at 18 places: half up, or down.

    Resolve under ``exact_decimals``. Whole units and the remainder, and the price's whole and
    fractional part, are multiplied apart, so no digit of the inputs is dropped and no product
    needs more than 38 digits unless the result itself does, which raises.
    """
    raw, price, unit = whole(raw), usd(price), power_of_ten(decimals)
    rest = whole(raw % unit)
    units = whole((raw - rest) / unit).cast("decimal(20,0)")
    share = (rest / unit).cast("decimal(18,18)")
    round_price = F.floor(price).cast("decimal(20,0)")
    fine_price = (price - round_price).cast("decimal(18,18)")
    fine = share * fine_price
    fine = usd(F.floor(fine, F.lit(18)) if down else fine)
    return usd(usd(units * price) + usd(share * round_price) + fine)
