"""Quotients that are rounded once, against Python's Decimal."""

from __future__ import annotations

import random
from decimal import ROUND_HALF_UP, Decimal, localcontext

import pytest
from pyspark.sql import functions as F

from tallyproof.functions.decimals import exact_decimals, percent, quotient
from tallyproof.operators.audit import percent_text


def plain(n: Decimal, d: Decimal, places: int, shift: int) -> Decimal | None:
    if n is None or d is None or d == 0:
        return None
    with localcontext() as context:
        context.prec = 120
        exact = n * 10**shift / d
        # far more digits than any half needs to be told from its neighbours
        return exact.quantize(Decimal(1).scaleb(-places), rounding=ROUND_HALF_UP)


def cases(scale: int, places: int, shift: int) -> list[tuple]:
    """Random pairs, and for many denominators the numerators next to every kind of half."""
    chance = random.Random(scale * 100 + places)
    unit = Decimal(1).scaleb(-scale)
    out = [(Decimal(0), Decimal(1)), (Decimal(1), Decimal(0)), (None, Decimal(1)), (Decimal(1), None)]
    for _ in range(400):
        d = chance.choice([1, -1]) * chance.randint(1, 10 ** chance.randint(1, 14)) * unit
        out.append((chance.choice([1, -1]) * chance.randint(0, 10 ** chance.randint(1, 15)) * unit, d))
        half = Decimal(2 * chance.randint(0, 10**6) + 1) / 2 * Decimal(1).scaleb(-places - shift)
        near = (half * d).quantize(unit)
        out += [(near + k * unit, d) for k in (-2, -1, 0, 1, 2)]
    return out


@pytest.mark.parametrize(("scale", "places", "shift"), [(6, 4, 2), (0, 6, 2), (0, 4, 2), (6, 4, 0), (6, 0, 0), (0, 8, 2)])
@pytest.mark.parametrize("exact", [False, True])
def test_quotients_equal_decimal(spark, scale, places, shift, exact):
    rows = cases(scale, places, shift)
    df = spark.createDataFrame(rows, f"n decimal(24,{scale}), d decimal(24,{scale})")
    value = quotient(F.col("n"), F.col("d"), places, scale, shift)
    if exact:
        with exact_decimals(spark):
            got = df.select("n", "d", value.alias("q"))
    else:
        got = df.select("n", "d", value.alias("q"))
    assert got.schema["q"].dataType.simpleString() == f"decimal(38,{places})"
    for r in got.collect():
        assert r.q == plain(r.n, r.d, places, shift), r


def test_a_half_that_only_a_second_rounding_meets(spark):
    change, base = Decimal("-0.098649"), Decimal("99.999950")
    df = spark.createDataFrame([(change, base), (Decimal(1), Decimal(0))], "n decimal(38,6), d decimal(38,6)")
    # 0.09864904932... is 0.098649 at six places and 0.0986 at four
    rows = df.select(percent_text(F.col("n"), F.col("d")).alias("t")).collect()
    assert [r.t for r in rows] == ["-0.0986%", "not_applicable"]
    twice = spark.createDataFrame([(Decimal("98.649960"), Decimal("100000.000000"))], df.schema)
    assert twice.select(percent(F.col("n"), F.col("d"), 4, 6).alias("q")).first().q == Decimal("0.0986")


def test_large_wholes_and_what_does_not_fit(spark):
    big = spark.createDataFrame([(Decimal(10**28 + 1), Decimal(3 * 10**17 + 7))], "n decimal(38,0), d decimal(38,0)")
    value = big.select(quotient(F.col("n"), F.col("d"), 4, 0, 2).alias("q")).first().q
    assert value == plain(Decimal(10**28 + 1), Decimal(3 * 10**17 + 7), 4, 2)
    over = spark.createDataFrame([(Decimal(10**37), Decimal(3))], "n decimal(38,0), d decimal(38,0)")
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE|cannot be represented"):
        over.select(quotient(F.col("n"), F.col("d"), 4, 0, 2)).collect()
    with pytest.raises(ValueError):
        quotient(F.lit(1), F.lit(3), 18, 0)
