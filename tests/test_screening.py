"""Boundary cases of netting, signals, funding and return matching."""

from __future__ import annotations

import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyproof.functions import formulas as fx
from tallyproof.functions.decimals import exact_decimals
from tallyproof.operators import manifest, matching, signals
from tallyproof.operators import transfers as tr

SCHEMA = (
    "token string, sender long, receiver long, value decimal(38,0), tx_hash long, evt_index long,"
    "block_time timestamp, block_number long, tx_index long"
)
T0 = datetime(2024, 1, 1)


def moves(spark, rows):
    """Rows of token, sender, receiver, value, tx, seconds."""
    data = [
        (token, a, b, Decimal(v), tx, i, T0 + timedelta(seconds=s), s // 12, tx % 100)
        for i, (token, a, b, v, tx, s) in enumerate(rows)
    ]
    return spark.createDataFrame(data, SCHEMA).withColumn(
        "block_date", F.col("block_time").cast("date")
    )


def segment():
    return F.floor(F.col("block_number") / 7200)


def test_a_round_trip_in_one_transaction_moves_nothing(spark):
    rows = moves(spark, [("A", 1, 2, 5, 1, 0), ("A", 2, 1, 5, 1, 0), ("A", 1, 2, 7, 2, 0),
                         ("A", 2, 3, 4, 2, 0)])
    netting = tr.address_netting(rows)
    got = {r.tx_hash: (r.movement_raw, r.gross_raw, r.net_residual_raw)
           for r in tr.tx_token_movement(netting).collect()}
    assert got == {1: (0, 10, 0), 2: (7, 11, 0)}
    assert {(r.tx_hash, r.address): r.net_raw for r in tr.nonzero_groups(netting).collect()} == {
        (2, 1): -7, (2, 2): 3, (2, 3): 4,
    }


@pytest.mark.parametrize(("groups", "days", "passes"), [(10, 4, True), (9, 4, False),
                                                        (10, 3, False)])
def test_the_gate_is_inclusive_on_both_counts(spark, groups, days, passes):
    rows = [("A", 1, 50 + i, 1, i, (i % days) * 86400 + i) for i in range(groups)]
    pairs = tr.qualify_pairs(tr.nonzero_groups(tr.address_netting(moves(spark, rows))), 10, 4)
    assert ([r.address for r in pairs.collect()] == [1]) is passes


def flags_of(spark, seconds):
    rows = [("A", 1, 50 + i, 1, i, s) for i, s in enumerate(seconds)]
    groups = tr.nonzero_groups(tr.address_netting(moves(spark, rows))).where("address = 1")
    gaps = tr.interval_features(tr.group_gaps(groups, segment()))
    rows = signals.temporal_pairs(gaps, tr.daily_concentration(groups)).collect()
    assert len(rows) == 1
    return (rows[0].clock_like, rows[0].same_second_burst, rows[0].single_day_burst)


def test_temporal_branches(spark):
    day = 86400
    assert flags_of(spark, [i * day // 2 for i in range(12)]) == (True, False, False)
    assert flags_of(spark, [0, 0, 0, day, 5 * day, 9 * day, 9 * day + 1]) == (False, True, False)
    burst = [60 * i * i for i in range(9)] + [3 * day]
    assert flags_of(spark, burst)[2] is True
    assert flags_of(spark, [5]) == (False, False, True)


def test_gaps_cross_segments(spark):
    seconds = [0, 10, 86400 * 3, 86400 * 3 + 5, 86400 * 9]
    rows = [("A", 1, 9, 1, i, s) for i, s in enumerate(seconds)]
    groups = tr.nonzero_groups(tr.address_netting(moves(spark, rows))).where("address = 1")
    gaps = sorted(r.gap for r in tr.group_gaps(groups, segment()).collect())
    assert gaps == [5, 10, 259190, 518395]


def test_cluster_flags_at_their_edges(spark):
    df = spark.createDataFrame(
        [(1, 10, 8000, 0), (2, 10, 7999, 5000), (3, 10, 8000, 5000), (4, 9, 10000, 10000),
         (5, 10, 7999, 4999)],
        "source long, cluster_size long, amount_share_bps long, hour_share_bps long",
    )
    got = {r.source: (r.is_candidate, r.is_strong) for r in signals.cluster_flags(df).collect()}
    assert got == {1: (True, False), 2: (True, False), 3: (True, True), 4: (False, False),
                   5: (False, False)}


def test_economic_gate_counts_equality_as_a_hit(spark):
    df = spark.createDataFrame(
        [(1, 4, 1), (2, 2, 1), (3, 1000, 499), (4, 5, 0)],
        "address long, nonzero_groups long, fired_groups long",
    )

    def hits(gate):
        rows = signals.economic_family(df, gate).where("economic").collect()
        return {r.address for r in rows}

    assert hits(2500) == {1, 2, 3}
    assert hits(5000) == {2}
    assert hits(0) == {1, 2, 3}


def test_fee_flag_needs_no_division(spark):
    df = spark.createDataFrame(
        [(Decimal(10**18), Decimal(2000), Decimal(2000 * 10**6)),
         (Decimal(10**18), Decimal(2000), Decimal(2000 * 10**6 + 1)),
         (Decimal(1), Decimal(2000), Decimal(0))],
        "w decimal(38,0), p decimal(12,2), m decimal(38,0)",
    )
    with exact_decimals(spark):
        rows = df.select(
            fx.fee_reaches_movement(F.col("w"), F.col("p"), F.col("m")).alias("f"),
            fx.fee_to_movement_bps(F.col("w"), F.col("p"), F.col("m")).alias("b"),
            fx.fee_usd(F.col("w"), F.col("p")).alias("u"),
        ).collect()
    assert [r.f for r in rows] == [True, False, True]
    assert [r.b for r in rows] == [10000, 9999, None]
    assert rows[0].u == Decimal(2000)


def funding_rows(spark):
    rows = [
        ("A", 90, 1, 50, 10, 100),
        ("A", 91, 2, 50, 11, 110),
        ("B", 92, 2, 50, 11, 110),
        ("A", 3, 80, 5, 12, 120),
        ("A", 93, 4, 50, 13, 130),
        ("A", 4, 81, 60, 13, 130),
        ("A", 93, 4, 9, 14, 140),
        *[("A", a, 70, 1, 1000 + a, 5000 + a) for a in (1, 2, 3, 4)],
    ]
    return moves(spark, rows)


def test_funding_sources_and_censoring(spark):
    rows = funding_rows(spark)
    late = rows.where("tx_hash >= 1000")
    groups = tr.nonzero_groups(tr.address_netting(late))
    actors = spark.createDataFrame([(1,), (2,), (3,), (4,)], "address long")
    first = tr.first_activity(groups, actors)
    look = tr.lookback_range_join(tr.actor_tx_net(rows), first)
    transactions = rows.groupBy("tx_hash").agg(F.min("sender").alias("tx_sender"))
    status = tr.funding_proxy(tr.first_funding_tx(look), transactions)
    got = {r.address: (r.tx_hash, r.source, r.single_source, r.external_initiation, r.is_proxy)
           for r in status.collect()}
    assert got == {
        1: (10, 90, True, True, True),
        2: (11, None, False, True, False),
        4: (14, 93, True, True, True),
    }
    ledger = signals.funding_status_ledger(
        actors, status.withColumn("is_listed", F.col("source") == 93)
    ).first()
    assert ledger.censored_actors == 1
    assert ledger.multi_source_actors == 1
    assert ledger.listed_source_actors == 1
    assert ledger.distinct_unlisted_sources == 1


def test_lookback_ends_at_its_own_limit(spark):
    day = 86400
    rows = moves(spark, [("A", 90, 1, 5, 1, 0), ("A", 91, 1, 5, 2, day), ("A", 1, 70, 1, 3, 31 * day)])
    first = tr.first_activity(
        tr.nonzero_groups(tr.address_netting(rows.where("tx_hash = 3"))),
        spark.createDataFrame([(1,)], "address long"),
    )
    kept = tr.lookback_range_join(tr.actor_tx_net(rows), first).collect()
    assert [r.tx_hash for r in kept] == [2]


# ---- return matching -------------------------------------------------------------------------


def brute_force(events, bps, window):
    """Mutual best pairs by trying every opposite pair."""
    def best(e):
        options = [
            (abs(e["at"] - o["at"]), abs(e["value"] - o["value"]), o["order"], o)
            for o in events
            if o["direction"] != e["direction"]
            and abs(e["at"] - o["at"]) <= window
            and abs(e["value"] - o["value"]) * 10000 <= bps * max(e["value"], o["value"])
        ]
        return min(options, key=lambda x: x[:3])[3]["order"] if options else None

    picks = {e["order"]: best(e) for e in events}
    return {
        (e["order"][3], picks[e["order"]][3])
        for e in events
        if e["direction"] == 0
        and picks[e["order"]]
        and picks.get(picks[e["order"]]) == e["order"]
    }


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("kind", ["spread", "equal amounts", "one instant"])
def test_matching_equals_brute_force(spark, seed, kind):
    rng = random.Random(seed)
    rows = []
    for i in range(70):
        a, b = rng.choice([(1, 2), (2, 1)])
        value = 1000 if kind == "equal amounts" else rng.choice([990, 1000, 1001, 1049, 1060, 7])
        second = 0 if kind == "one instant" else rng.randrange(0, 400_000, 600)
        rows.append(("A", a, b, value, rng.randrange(30), second))
    df = moves(spark, rows)
    local = [
        {
            "direction": int(r.sender > r.receiver),
            "at": int((r.block_time - T0).total_seconds()),
            "value": int(r.value),
            "order": (r.block_number, r.tx_index, r.tx_hash, r.evt_index),
        }
        for r in df.collect()
    ]
    events = matching.pair_events(df, tr.reverse_edges(df))
    matches = matching.mutual_best_match(events, matching.TOLERANCES, timedelta(days=7)).collect()
    for bps in matching.TOLERANCES:
        got = {(m.forward.evt_index, m.reverse.evt_index) for m in matches if m.bps == bps}
        assert got == brute_force(local, bps, 7 * 86400)
    cells = {
        (c.time_window, c.tolerance_bps): c.matched_pairs
        for c in matching.return_grid(
            spark.createDataFrame(matches), matching.TOLERANCES, matching.WINDOWS
        ).collect()
    }
    assert len(cells) == 20
    for name, window in matching.WINDOWS.items():
        for bps in matching.TOLERANCES:
            expected = brute_force(local, bps, int(window.total_seconds()))
            assert cells[name, bps] == len(expected)


def test_a_gap_equal_to_the_window_still_matches(spark):
    df = moves(spark, [("A", 1, 2, 100, 1, 0), ("A", 2, 1, 100, 2, 300)])
    events = matching.pair_events(df, tr.reverse_edges(df))
    matches = matching.mutual_best_match(events, [0], timedelta(minutes=5))
    assert matches.count() == 1
    assert matching.mutual_best_match(events, [0], timedelta(seconds=299)).count() == 0


# ---- profiles and manifests ------------------------------------------------------------------


def test_percentiles_are_exact_on_skewed_values(spark):
    rng = random.Random(5)
    values = [rng.choice([0, 1, 5, 10**12, rng.randrange(10**9)]) for _ in range(997)]
    df = spark.createDataFrame([("A", v) for v in values], "token string, v long")
    got = {r.percentile: r.percentile_value
           for r in signals.distribution_profile(df, "v", ["token"]).collect()}
    ordered = sorted(values)
    assert got == {k: ordered[-(-k * len(values) // 100) - 1] for k in range(1, 100)}


def test_approximate_profile_has_the_same_grid(spark):
    df = spark.range(1000).select(F.lit("A").alias("token"), F.col("id").alias("v"))
    rows = signals.approximate_profile(df, "v", ["token"]).collect()
    assert sorted(r.percentile for r in rows) == list(range(1, 100))
    assert all(abs(r.percentile_value - r.percentile * 10) <= 2 for r in rows)


def test_manifest_round_trip_and_damage(spark):
    rows = spark.range(1, 103).select(F.col("id").alias("address"), (F.col("id") % 9 == 0).alias("f"))
    chunks = manifest.manifest_pack(rows, "address", "f", 25, F.floor(F.col("address") / 16))
    declared = manifest.manifest_digest(chunks)
    first = declared.first()
    assert (first.chunks, first.entries, first.flagged) == (5, 102, 11)
    assert manifest.manifest_unpack_check(chunks, declared).first().manifest_matches
    broken = chunks.withColumn("chunk_text", F.replace("chunk_text", F.lit("7:0"), F.lit("7:1")))
    assert not manifest.manifest_unpack_check(broken, declared).first().manifest_matches
    import hashlib

    def joined(parts):
        return hashlib.sha256("~".join(parts).encode()).hexdigest()

    leaves = [r.chunk_sha256 for r in chunks.orderBy("chunk").collect()]
    assert first.manifest_sha256 == joined(leaves)
    tree = joined([joined([joined(leaves[0:2]), joined(leaves[2:4])]), joined([joined(leaves[4:])])])
    assert manifest.manifest_digest(chunks, fan_in=2).first().manifest_sha256 == tree


def test_binary_keys_are_shown_as_hex(spark):
    """Chain data has binary addresses and hashes; the test tables only integers."""
    from tallyproof.plans import liquidations as lq

    rows = spark.createDataFrame(
        [(bytearray(b"\xab\x01"), 3, "2024-01-01", "T", 5.0, True, 4.0), (bytearray(b"\xab\x02"), 1, "2024-01-02", "U", 9.0, True, 2.0)],
        "tx_hash binary, evt_index int, block_time string, debt_symbol string, debt_amount_usd double, left_found boolean, left_amount_usd double",
    )
    top = lq.largest_difference(rows, "left", "debt").first()
    assert top.max_debt_diff_tx_hash == "0xAB02" and top.max_debt_diff_abs_diff == 7.0
