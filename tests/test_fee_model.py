"""Boundary cases of the fee model, its repairs and the state lookup."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyproof.functions import formulas as fx
from tallyproof.functions.decimals import exact_decimals, six_dp, usd
from tallyproof.operators import enrich, intervals, reconcile
from tallyproof.plans import fee_model as fm

ORDER = ["block_number", "evt_index"]


def money(value):
    return None if value is None else Decimal(value)


@pytest.fixture(scope="module")
def history(spark):
    """Pool 1 has two settings in block 10 and one in block 20; pool 2 none; pool 9 no entity."""
    pools = spark.createDataFrame(
        [(1, 100, 101, 3000, 0, 0), (2, 200, 201, 500, 0, 0)],
        "pool long, token0 long, token1 long, fee_tier int, created_block_number long,"
        "created_evt_index long",
    )
    settings = spark.createDataFrame(
        [(1, 10, 5, 4, 6), (1, 10, 9, 5, 7), (1, 20, 1, 0, 10), (8, 3, 3, 4, 4)],
        "pool long, block_number long, evt_index long, feeprotocol0 int, feeprotocol1 int",
    )
    return pools, settings


FACTS = [
    (1, 0, 0, "at creation"),
    (1, 0, 1, "after creation"),
    (1, 10, 4, "before first"),
    (1, 10, 5, "at first"),
    (1, 10, 6, "between"),
    (1, 10, 9, "at second"),
    (1, 10, 10, "after second"),
    (1, 20, 0, "before third"),
    (1, 99, 0, "open end"),
    (2, 50, 1, "no setting"),
    (9, 50, 1, "no entity"),
]


@pytest.mark.parametrize("strategy", ["range", "fill", "auto"])
@pytest.mark.parametrize("width", [1, 7, 1000])
def test_lookup_is_strict_at_both_ends(spark, history, strategy, width):
    facts = spark.createDataFrame(FACTS, "pool long, block_number long, evt_index long, note string")
    points = fm.fee_points(*history)
    segment = F.floor(F.col("block_number") / width)
    rows = intervals.interval_lookup(facts, points, ["pool"], ORDER, segment, strategy)
    got = {r.note: (r.feeprotocol0, r.feeprotocol1) for r in rows.collect()}
    assert got == {
        "after creation": (0, 0),
        "before first": (0, 0),
        "between": (4, 6),
        "after second": (5, 7),
        "before third": (5, 7),
        "open end": (0, 10),
        "no setting": (0, 0),
    }


def test_intervals_agree_with_and_without_segments(history):
    points = fm.fee_points(*history)
    plain = intervals.state_intervals(points, ["pool"], ORDER)
    cut = intervals.state_intervals(points, ["pool"], ORDER, F.floor(F.col("block_number") / 8))
    assert sorted(map(tuple, plain.collect()), key=str) == sorted(map(tuple, cut.collect()), key=str)


@pytest.mark.parametrize(
    ("divisor", "share"),
    [(None, "0"), (0, "0"), (3, "0"), (4, "2.5"), (7, "1.428571428571428571"),
     (10, "1"), (11, "0")],
)
def test_revenue_needs_an_active_divisor(spark, divisor, share):
    df = spark.createDataFrame([(Decimal(10), divisor)], "fees decimal(38,18), divisor int")
    row = df.select(fx.revenue_from_divisor(F.col("fees"), F.col("divisor")).alias("r")).first()
    assert row.r == Decimal(share)


def test_fee_keeps_digits_that_default_arithmetic_drops(spark):
    base = "12345678.123456789012345678"
    df = spark.createDataFrame([(Decimal(base), 3000), (None, 3000)], "b decimal(38,18), t int")
    with exact_decimals(spark):
        rows = df.select(fx.fee_from_ppm(F.col("b"), F.col("t")).alias("f"))
    # The per-million share is 12.345678123456789012 at 18 places.
    assert [r.f for r in rows.collect()] == [Decimal("37037.034370370367036000"), Decimal(0)]


def test_exact_decimals_restores_the_session(spark):
    name = "spark.sql.decimalOperations.allowPrecisionLoss"
    before = spark.conf.get(name)
    with exact_decimals(spark):
        assert spark.conf.get(name) == "false"
    assert spark.conf.get(name) == before


CASES = [
    # legacy, fixed, changed, model code, strict code
    ("200", "100", True, fx.ORDINARY, fx.ORDINARY),
    ("200.000001", "100", True, fx.MATERIAL, fx.MATERIAL),
    ("100.0000001", "100", False, None, None),
    (None, "5", True, fx.ORDINARY, None),
    ("5", None, False, None, None),
    ("5", "0", True, fx.ORDINARY, fx.ORDINARY),
]


@pytest.mark.parametrize(("legacy", "fixed", "changed", "model", "strict"), CASES)
def test_the_two_reason_rules(spark, legacy, fixed, changed, model, strict):
    df = spark.createDataFrame(
        [(money(legacy), money(fixed))], "l decimal(38,18), f decimal(38,18)"
    )
    left, right = F.col("l"), F.col("f")
    row = df.select(
        fx.changed_at_six_dp(left, right).alias("changed"),
        fx.reason_code_model(left, right).alias("model"),
        fx.reason_code_strict(left, right).alias("strict"),
    ).first()
    assert row.changed is changed
    if changed:
        assert row.model == model
    if strict:
        assert row.strict == strict


def trades_frame(spark):
    at = datetime(2024, 1, 1, 10, 30, 15)
    rows = [
        (1, 11, 1, 1, 100, Decimal("2"), Decimal("10.000000"), at, "a"),
        (2, 12, 1, 1, 100, Decimal("2"), Decimal("5.000000"), at, "a"),
        (3, 13, 1, 1, 101, Decimal("2"), Decimal("5.000000"), at, "a"),
        (4, 14, 1, 1, 100, Decimal("2"), None, at, "a"),
        (5, 15, 1, 1, None, Decimal("2"), Decimal("9.000000"), at, "a"),
        (6, 16, 1, 2, 100, Decimal("2"), Decimal("10.000000"), at, "a"),
    ]
    schema = (
        "block_number long, tx_hash long, evt_index long, pool long, token_sold long,"
        "token_sold_amount decimal(18,6), amount_usd decimal(18,6), block_time timestamp,"
        "blockchain string"
    )
    prices = spark.createDataFrame(
        [(100, datetime(2024, 1, 1, 10, 30), Decimal("2.5")),
         (100, datetime(2024, 1, 1, 10, 31), Decimal("99"))],
        "asset long, bucket timestamp, price decimal(24,8)",
    )
    return spark.createDataFrame(rows, schema), prices


@pytest.mark.parametrize("side_bytes", [0, 1 << 20])
def test_inline_repairs_equal_the_overlay(spark, side_bytes):
    trades, prices = trades_frame(spark)
    scope = F.col("pool") == 1
    inline = enrich.inline_repairs(trades, prices, scope, side_bytes=side_bytes)
    repairs = enrich.accepted_repairs(enrich.valued_rows(trades.where(scope), prices))
    overlay = enrich.repair_overlay(
        trades, repairs, ["block_number", "tx_hash", "evt_index", "pool"]
    )
    shown = ["tx_hash", "fee_base_usd", "is_repaired", "reason_code"]
    got = sorted(map(tuple, inline.select(*shown).collect()))
    assert got == sorted(map(tuple, overlay.select(*shown).collect()))
    assert got == [
        (11, Decimal("5"), True, fx.ORDINARY),
        (12, Decimal("5"), False, None),
        (13, Decimal("5"), False, None),
        (14, Decimal("5"), True, fx.ORDINARY),
        (15, Decimal("9"), False, None),
        (16, Decimal("10"), False, None),
    ]


def test_price_join_keeps_every_row_and_misses_stay_null(spark):
    trades, prices = trades_frame(spark)
    rows = enrich.minute_price_join(trades, prices, "token_sold", "block_time").collect()
    assert len(rows) == 6
    assert {r.tx_hash for r in rows if r.price is None} == {13, 15}


def test_latest_version_prefers_dated_rows(spark):
    df = spark.createDataFrame(
        [(1, "old", None), (1, "new", date(2024, 1, 1)), (2, "only", None)],
        "k int, symbol string, updated date",
    )
    rows = enrich.latest_dimension_row(df, ["k"], "updated", ["symbol"]).collect()
    assert {r.k: r.symbol for r in rows} == {1: "new", 2: "only"}


def test_numbers_run_over_segments_without_gaps(spark):
    df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("block_number"))
    df = df.withColumn("evt_index", F.col("block_number") % 3).withColumn("tx_hash", F.lit(1))
    rows = fm.numbered_affected(df, F.floor(F.col("block_number") / 64)).collect()
    assert {r.affected_row_number - 1 for r in rows} == set(range(1000))
    assert all(r.affected_row_number == r.block_number + 1 for r in rows)
    assert {r.affected_row_count for r in rows} == {1000}


# ---- seeded faults: exactly the right counter moves ------------------------------------------


def base_rows(spark):
    return spark.range(100).select(
        (F.col("id") % 10).alias("tx_hash"), F.col("id").alias("evt_index"),
        F.col("id").cast("decimal(38,18)").alias("fees_usd"), F.lit("x").alias("label"),
    )


def moved(report, clean):
    return {k for k, v in report.first().asDict().items() if v != clean[k]}


FAULTS = {
    "drop": (lambda d: d.where("evt_index <> 5"),
             {"matched_keys", "left_only_keys", "fees_usd_row_difference_sum"}),
    "extra": (lambda d: d.unionByName(d.where("evt_index = 5").withColumn("evt_index", F.lit(500))),
              {"right_only_keys", "fees_usd_row_difference_sum"}),
    "value": (lambda d: d.withColumn("fees_usd", F.when(F.col("evt_index") == 5, usd(F.lit(9)))
                                     .otherwise(F.col("fees_usd"))),
              {"field_mismatch_keys", "fees_usd_mismatch_keys", "fees_usd_row_difference_sum"}),
    "null": (lambda d: d.withColumn("label", F.when(F.col("evt_index") != 5, F.col("label"))),
             {"field_mismatch_keys", "label_mismatch_keys"}),
}


@pytest.mark.parametrize("fault", FAULTS)
def test_field_mismatch_moves_only_its_counters(spark, fault):
    base = base_rows(spark)
    change, expected = FAULTS[fault]

    def report(other):
        return reconcile.field_mismatch(
            base, other, ["tx_hash", "evt_index"], ["fees_usd", "label"], ["fees_usd"]
        )

    clean = report(base).first().asDict()
    assert clean["matched_keys"] == 100
    assert moved(report(change(base)), clean) == expected


def test_key_audit_counts_duplicates_and_null_parts(spark):
    df = spark.createDataFrame(
        [(1, 1, 1.0), (1, 1, None), (1, 2, 1.0), (None, 2, 1.0), (None, 2, 1.0)],
        "a int, b int, v double",
    )
    row = reconcile.key_audit(df, ["a", "b"], "v").first()
    assert row.asDict() == {
        "row_count": 5, "distinct_keys": 3, "duplicate_surplus_rows": 2, "null_key_rows": 2,
        "unpriced_rows": 1,
    }


def test_null_key_parts_match_nothing(spark):
    left = spark.createDataFrame([(1, 1), (1, 1), (None, 2)], "a int, b int")
    right = spark.createDataFrame([(1, 1), (None, 2), (3, 3)], "a int, b int")
    row = reconcile.key_multiset_coverage(left, right, ["a", "b"]).first()
    assert tuple(row) == (1, 1, 2, 1)


def test_row_diff_separates_expected_and_unexpected_changes(spark):
    base = spark.createDataFrame(
        [(1, money("1")), (2, money("2")), (3, money("3")), (4, None)], "k int, v decimal(38,6)"
    )
    changed = spark.createDataFrame(
        [(2, money("9")), (3, money("8")), (4, money("7"))], "k int, n decimal(38,6)"
    )
    expected = spark.createDataFrame([(1, money("1")), (2, money("9"))], "k int, n decimal(38,6)")
    row = reconcile.row_diff(base, changed, expected, ["k"], "v", "n").first().asDict()
    assert row["model_changed_rows"] == 3
    assert row["changed_expected_rows"] == 1
    assert row["expected_rows_not_changed"] == 1
    assert row["changed_unaffected_rows"] == 2
    assert row["unexpectedly_filled_null_rows"] == 1
    assert row["newly_null_rows"] == 0


def test_event_call_match_counts_exact_wrong_and_missing(spark):
    schema = "tx int, pool int, amount int"
    events = spark.createDataFrame([(1, 1, 5), (1, 1, 5), (1, 1, 6), (2, 1, 1)], schema)
    calls = spark.createDataFrame([(1, 1, 5), (1, 1, 7), (3, 1, 1)], schema)
    row = reconcile.event_call_match(events, calls, ["tx", "pool"], ["amount"]).first()
    assert tuple(row) == (4, 3, 1, 1, 2, 1)


def test_display_residual_is_told_apart_from_a_real_one(spark):
    rows = spark.createDataFrame(
        [(money("0.0000015"), money("0.00000075"), money("0.00000075"))],
        "fees_usd decimal(38,18), revenue_usd decimal(38,18), supply_side_fees_usd decimal(38,18)",
    )
    from tallyproof.operators.audit import display_residual

    row = display_residual(rows).first()
    assert row.unrounded_residual_usd == 0
    assert row.residual_class in ("NONE", "DISPLAY_ROUNDING_6DP")
    assert (row.display_residual_usd != 0) == (row.residual_class == "DISPLAY_ROUNDING_6DP")


def test_six_places_round_half_up(spark):
    df = spark.createDataFrame([(money("0.0000005"),), (money("-0.0000005"),)], "v decimal(38,18)")
    got = [r.r for r in df.select(six_dp(F.col("v")).alias("r")).collect()]
    assert got == [Decimal("0.000001"), Decimal("-0.000001")]


def test_values_keep_every_digit_of_price_and_amount(spark):
    from decimal import ROUND_DOWN, ROUND_HALF_UP, Decimal, localcontext

    from tallyproof.functions import formulas as fx
    from tallyproof.functions.decimals import exact_decimals, units_times_price

    cases = [
        (100 * 10**6, 6, "0.9987"), (5 * 10**6, 6, "0.00001234"), (10**24, 18, "1.000000000000000001"),
        (10**18, 18, "1788.4567"), (123456789012345678901, 18, "98765.432109876543210987"), (7, 18, "0.3"),
        (0, 0, "5"), (10**24 + 1, 18, "0.123456789012345678"),
    ]
    rows = spark.createDataFrame(
        [(i, Decimal(r), d, Decimal(p)) for i, (r, d, p) in enumerate(cases)],
        "i int, raw decimal(38,0), d int, price decimal(38,18)",
    )
    with exact_decimals(spark):
        out = rows.select(
            "i",
            units_times_price(F.col("raw"), F.col("d"), F.col("price")).alias("near"),
            units_times_price(F.col("raw"), F.col("d"), F.col("price"), down=True).alias("low"),
            fx.fee_reaches_movement(F.col("raw"), F.col("price"), F.lit(1_788_456_700).cast("decimal(38,0)")).alias("hit"),
            fx.fee_to_movement_bps(F.col("raw"), F.col("price"), F.lit(1_788_456_701).cast("decimal(38,0)")).alias("bps"),
        )
    with localcontext() as context:
        context.prec = 90
        step = Decimal(1).scaleb(-18)
        for row in out.collect():
            raw, d, p = cases[row.i]
            exact = Decimal(raw).scaleb(-d) * Decimal(p).quantize(step)
            assert row.near == exact.quantize(step, ROUND_HALF_UP)
            assert row.low == exact.quantize(step, ROUND_DOWN)
            fee = Decimal(raw).scaleb(-18) * Decimal(p).quantize(step)
            assert row.hit == (fee >= Decimal("1788.4567"))
            if fee < 10**9:
                assert row.bps == int(fee * 10_000 / Decimal("1788.456701"))


@pytest.mark.parametrize("strategy", ["range", "fill", "auto"])
def test_tied_points_do_not_depend_on_the_order_of_the_input(spark, strategy):
    from tallyproof.operators.intervals import interval_lookup

    points = [(1, 5, 0, 7), (1, 5, 0, 9), (1, 5, 0, 8), (1, 9, 0, 1), (1, 9, 0, 2)]
    facts = spark.createDataFrame([(1, 6, 0), (1, 9, 0), (1, 10, 3)], "pool int, block_number int, evt_index int")
    for order in (points, points[::-1]):
        side = spark.createDataFrame(order, "pool int, block_number int, evt_index int, fee int").coalesce(1)
        got = interval_lookup(facts, side, ["pool"], ["block_number", "evt_index"], F.floor(F.col("block_number") / 4), strategy)
        assert sorted((r.block_number, r.fee) for r in got.collect()) == [(6, 9), (10, 2)]


def test_a_lost_key_moves_the_residual_of_the_ledger(spark):
    from tallyproof.plans import liquidations as lq
    from tallyproof.registry import liquidations as queries

    folder = "/root/testdata/sf0.001"
    model, rows = queries.model(spark, folder), queries.reconciled(spark, folder)
    assert {r.partition_residual for r in lq.closed_ledger(rows, model).collect()} == {0}
    lost = model.agg(F.count_if(F.col("tx_hash") % 7 == 0)).first()[0]
    kept = rows.where(F.col("tx_hash") % 7 != 0)
    assert {r.partition_residual for r in lq.closed_ledger(kept, model).collect()} == {lost}


def test_an_actor_without_a_class_moves_the_residual(spark):
    from tallyproof.operators import signals

    fused = spark.createDataFrame([(1, 0), (2, 1), (3, 4), (4, None)], "address long, families int")
    fused = fused.withColumn("actor_class", signals.class_of(F.col("families")))
    actors = spark.createDataFrame([(i,) for i in range(1, 7)], "address long")
    assert {r.partition_residual for r in signals.class_partition(fused, actors).collect()} == {3}
