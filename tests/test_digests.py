"""Digests of ranges against full joins, and dates derived from changed inputs."""

from __future__ import annotations

import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from tallyproof.operators import digests, reconcile
from tallyproof.plans import refresh
from tallyproof.registry import fees
from tallyproof.registry import screening as rs
from tallyproof.sources import tables
from tallyproof.sources import testdata as td

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "day date, k long, e long, a string, v long"


def rows(n: int) -> list[tuple]:
    chance = random.Random(n)
    return [
        (date(2024, 1, 1 + i % 9) if i % 50 else None, i // 3, i % 3, chance.choice(["x", "", None]), chance.choice([None, 1, 2]))
        for i in range(n)
    ]


def both(spark, left, right) -> tuple:
    sides = [spark.createDataFrame(x, SCHEMA).repartition(3) for x in (left, right)]
    args = (["k", "e"], ["day", "a", "v"], ["v"])
    got = digests.ranged_field_mismatch(*sides, "day", *args, buckets=8).first().asDict()
    want = reconcile.field_mismatch(*sides, *args).first().asDict()
    return got, {k: v if v is not None else 0 for k, v in want.items()}


def changed(data: list[tuple], spots: list[int], change) -> list[tuple]:
    return [change(r) if i in set(spots) else r for i, r in enumerate(data)]


@pytest.mark.parametrize("change", [
    lambda r: (*r[:3], "other", r[4]),
    lambda r: (*r[:3], None, r[4]),
    lambda r: (*r[:4], 7),
    lambda r: (date(2024, 2, 1), *r[1:]),
    lambda r: (None, *r[1:]),
    lambda r: (r[0], r[1] + 10_000, *r[2:]),
])
def test_seeded_faults_are_counted_exactly(spark, change):
    data = rows(900)
    got, want = both(spark, data, changed(data, [0, 5, 333, 334, 899], change))
    assert got == want and got["field_mismatch_keys"] + got["left_only_keys"] > 0


def test_lost_added_and_incomplete_keys(spark):
    data = rows(400) + [(date(2024, 1, 2), None, 1, "n", 3), (date(2024, 1, 3), 7777, None, "m", 4)]
    assert both(spark, data, data)[0] == both(spark, data, data)[1]
    got, want = both(spark, data, data[10:] + [(date(2024, 3, 1), 9999, 0, "new", 1)])
    assert got == want and got["right_only_keys"] == 3 and got["left_only_keys"] == 12
    for left, right in ((data, []), ([], data), ([], [])):
        got, want = both(spark, left, right)
        assert got == want


def test_null_and_moved_values_change_a_hash(spark):
    a = spark.createDataFrame([(1, None, "x"), (1, "x", None)], "k int, p string, q string")
    found = digests.range_digests(a, F.col("p"), F.lit(0), ["k"], ["p", "q"]).select("hash_sum", "hash_xor").collect()
    assert len(set(found)) == 2


def test_equal_snapshots_meet_no_row_join(spark):
    data = spark.createDataFrame(rows(300), SCHEMA)
    compared = digests.ranged_field_mismatch(data, data, "day", ["k", "e"], ["a", "v"], buckets=8)
    plan = compared._jdf.queryExecution().optimizedPlan().toString()
    assert "FullOuter" not in plan or "LocalRelation <empty>" in plan
    assert compared.first()["matched_keys"] == 300


def test_only_rows_of_differing_ranges_are_paired(spark):
    data = rows(3000)
    left = spark.createDataFrame(data, SCHEMA)
    right = spark.createDataFrame(changed(data, [1234], lambda r: (*r[:3], "other", r[4])), SCHEMA)
    shown = digests.range_summary(left, right, F.col("day"), digests.key_bucket(["k", "e"]), ["k", "e"], ["a", "v"])
    hit = shown.where("differing_ranges > 0").collect()
    assert len(hit) == 1 and hit[0].differing_ranges == 1 and hit[0].rows_to_compare <= 40


def test_a_late_price_refreshes_its_date_only(spark):
    t = fees.stored_trades(spark, FOLDER)
    pools, settings, prices = td.pools(spark, FOLDER), td.settings(spark, FOLDER), td.token_prices(t)
    prices = tables.frozen_relation(prices, "prices")
    scope = F.lit(True)
    # a day on which a trade is repaired by its price
    seen = t.join(prices, (F.col("token_sold") == F.col("asset")) & (F.col("block_date") == F.to_date("bucket")))
    day = seen.agg(F.min("block_date")).first()[0]
    old = prices.where(F.to_date("bucket") != F.lit(day))
    whole = refresh.refresh_bounds(fees.START, fees.TODAY, incremental=False)

    def build(p):
        return refresh.incremental_build(t, pools, settings, p, scope, fees.seg(), "day")

    path = tables.fresh_path(spark, "test-drift")
    refresh.full_refresh(path, build(old), whole)
    before = refresh.input_digests(t, settings, old)
    dates = refresh.changed_dates(before, refresh.input_digests(t, settings, prices), t)
    assert dates == [day]
    assert refresh.changed_dates(before, before, t) == []
    stale = tables.read_table(spark, path)
    assert refresh.drift_refresh(spark, path, build(prices), dates, whole) == [day]
    fresh, full = tables.read_table(spark, path), build(prices)(whole).select(*refresh.TRADE_COLUMNS)
    columns = refresh.TRADE_COLUMNS
    assert fresh.select(*columns).exceptAll(full).count() == 0 and full.exceptAll(fresh.select(*columns)).count() == 0
    moved = stale.exceptAll(fresh).select("block_date").distinct().collect()
    assert [r[0] for r in moved] == [day]


def test_a_fault_in_the_screen_fails_the_cases(spark, monkeypatch):
    from tallyproof.plans import screening as sc

    good = rs.recomputed(spark, FOLDER, False)
    assert good.count() == good.where("case_passes").count() > 0

    def faulty(gaps):
        return sound(gaps).withColumn("zero_gap_share_bps", F.lit(10_000).cast("bigint"))

    sound = sc.interval_features
    monkeypatch.setattr(sc, "interval_features", faulty)
    assert rs.recomputed(spark, FOLDER, False).where("NOT case_passes").count() > 0
    monkeypatch.undo()

    def always(*args):
        return F.lit(True)

    monkeypatch.setattr(sc, "fee_reaches_movement", always)
    assert rs.recomputed(spark, FOLDER, False).where("NOT case_passes").count() > 0
