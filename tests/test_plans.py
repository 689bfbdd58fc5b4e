"""Plans and ordered scans under skew: what reaches the scan and what moves."""

from __future__ import annotations

import io
from contextlib import redirect_stdout
from datetime import datetime

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyproof.operators import enrich, intervals
from tallyproof.operators.ordered import Carry, carry, first_per_key, running_total
from tallyproof.operators.sides import sized_side
from tallyproof.registry import fees
from tallyproof.registry import screening as screens
from tallyproof.session import stored_copies
from tallyproof.sources import scans, tables
from tallyproof.sources import testdata as td

FOLDER = "/root/testdata/sf0.001"


def plan(df) -> str:
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def test_window_bounds_and_columns_reach_the_scan(spark):
    rows = scans.window_scan(
        td.trades_all(spark, FOLDER), {**td.CHAIN, "version": "F"}, "block_time",
        datetime(1996, 1, 1), datetime(1997, 1, 1), {"tx_hash": "tx", "pool": "pool"},
    )
    text = plan(rows)
    assert "GreaterThanOrEqual(l_shipdate" in text
    assert "EqualTo(l_linestatus,F)" in text
    schema = text.split("ReadSchema: ")[1].splitlines()[0]
    assert "l_extendedprice" not in schema
    assert "Exchange" not in text


def test_pruned_scan_skips_partitions(spark):
    rows = td.trades_all(spark, FOLDER).withColumn("block_month", F.trunc("block_date", "month"))
    path = tables.fresh_path(spark, "test-months")
    tables.trade_sink(rows, path, rows.columns, "block_month")
    stored = tables.read_table(spark, path)
    window = (datetime(1996, 1, 10), datetime(1996, 2, 10))
    pruned = scans.partition_pruned_scan(
        stored, td.CHAIN, "block_time", *window, partition="block_month"
    )
    assert "PartitionFilters: [isnotnull(block_month" in plan(pruned)
    exact = scans.leg_scan(
        stored.withColumn("transaction_type", F.lit("x")), td.CHAIN, "x", *window, ["tx_hash"]
    )
    assert "block_month" in plan(exact).split("PartitionFilters: ")[1].splitlines()[0]


def test_month_bounds_cover_the_window():
    first, last = scans.months_of_window(datetime(2026, 6, 14), datetime(2026, 7, 14))
    assert (first.isoformat(), last.isoformat()) == ("2026-06-01", "2026-08-01")
    first, last = scans.months_of_window(datetime(2026, 6, 1), datetime(2026, 7, 1))
    assert (first.isoformat(), last.isoformat()) == ("2026-06-01", "2026-07-01")
    assert scans.dates_of_window(datetime(2026, 6, 14), datetime(2026, 7, 14, 12))[1].day == 15


def test_first_rows_are_cut_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    text = plan(first_per_key(df, ["k"], ["id"]))
    assert text.count("WindowGroupLimit") >= 2
    assert "Partial" in text


def hot(spark):
    """A third of the rows has one key; values are sparse."""
    key = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50)
    value = F.when(F.col("id") % 17 == 0, F.struct(F.col("id").alias("v")))
    return spark.range(6000).select(
        key.alias("k"), F.pmod(F.xxhash64("id"), F.lit(10_000)).alias("at"), "id", value.alias("s")
    )


@pytest.mark.parametrize("backward", [False, True])
@pytest.mark.parametrize("current", [False, True])
def test_carry_equals_one_window_per_key(spark, backward, current):
    df = hot(spark)
    got = carry(df, ["k"], F.floor(F.col("at") / 100), ["at", "id"],
                Carry("s", "out", backward, current))
    step = [F.col(c).desc() if backward else F.col(c).asc() for c in ("at", "id")]
    window = Window.partitionBy("k").orderBy(*step)
    window = window.rowsBetween(Window.unboundedPreceding, 0 if current else -1)
    want = df.withColumn("out", F.last("s", ignorenulls=True).over(window))
    assert got.exceptAll(want).count() == 0
    assert got.count() == want.count()


def test_running_total_equals_one_window_per_key(spark):
    df = hot(spark).drop("s")
    got = running_total(
        df, ["k"], F.floor(F.col("at") / 100), ["at", "id"], F.col("id"), "upto", "all"
    )
    keyed = Window.partitionBy("k")
    want = df.withColumn("upto", F.sum("id").over(keyed.orderBy("at", "id"))).withColumn(
        "all", F.sum("id").over(keyed)
    )
    assert got.exceptAll(want).count() == 0
    assert got.count() == want.count()


def test_a_side_is_broadcast_only_below_its_bound_in_bytes(spark):
    side = spark.range(100).withColumnRenamed("id", "k")
    small, is_small = sized_side(side, 1 << 20)
    large, is_large = sized_side(side, 10)
    assert (is_small, is_large) == (True, False)
    facts = spark.range(1000).withColumnRenamed("id", "k")
    assert "BroadcastHashJoin" in plan(facts.join(small, "k"))
    assert large.count() == 100


def test_price_and_transaction_scans_are_bounded_by_the_window(spark, tmp_path):
    """The join does not imply the bound; it must reach the scan of the side table."""
    from datetime import datetime

    from tallyproof.plans import liquidations, screening
    from tallyproof.registry import screening as queries
    from tallyproof.sources import testdata as td

    folder = "/root/testdata/sf0.001"
    prices = td.month_prices(spark, folder)
    prices.write.parquet(f"{tmp_path}/prices")
    model = liquidations.liquidation_model(
        td.liquidations_raw(spark, folder), td.token_metadata(spark, folder),
        datetime(1996, 1, 10), datetime(1996, 3, 2),
    )
    priced = liquidations.liquidation_priced(
        model, spark.read.parquet(f"{tmp_path}/prices"), "month", (datetime(1996, 1, 10), datetime(1996, 3, 2))
    )
    filters = [x for x in plan(priced).split("\n") if "PushedFilters" in x and "bucket" in x]
    assert len(filters) == 2
    assert all("GreaterThanOrEqual(bucket,1996-01-01" in x and "LessThan(bucket,1996-03-02" in x for x in filters)

    moved = td.transfers(spark, folder)
    td.transactions(moved).write.parquet(f"{tmp_path}/txs")
    given = screening.Inputs(
        moved, spark.read.parquet(f"{tmp_path}/txs"), td.hour_prices(moved), td.exchange_list(spark, folder), F.lit(0)
    )
    rules = queries.rules()
    stages = screening.build_stages(given, rules, freeze=False)
    text = plan(stages.signals)
    scans = [x for x in text.split("\n") if "PushedFilters" in x and "block_time" in x]
    assert any("GreaterThanOrEqual(block_time" in x and "LessThan(block_time" in x for x in scans)


def test_actors_are_kept_before_legs_are_netted(spark):
    from tallyproof.operators import transfers as tr

    rows = spark.createDataFrame(
        [("A", 1, 2, 10, 100)], "token string, sender long, receiver long, value long, tx_hash long"
    )
    rows = rows.selectExpr("*", "timestamp'2024-01-01' AS block_time", "date'2024-01-01' AS block_date", "1L AS block_number", "1L AS tx_index", "1L AS evt_index")
    actors = spark.createDataFrame([(1, "A")], "address long, token string")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for df in (tr.actor_tx_net(rows, actors), tr.counterparty_features(rows, actors)):
            tree = plan(df).split("\n\n\n")[0]
            assert tree.index("LeftSemi") > tree.rindex("HashAggregate")
            assert df.count() == 1
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_stored_copies_are_released(spark):
    from pathlib import Path

    from tallyproof.session import stored_copies
    from tallyproof.sources.tables import frozen_relation

    with stored_copies(spark) as made:
        assert frozen_relation(spark.range(5), "kept").count() == 5
        folders = [Path(p.removeprefix("file:")) for p in made]
        assert folders and all(f.exists() for f in folders)
    assert not any(f.exists() for f in folders)


def test_a_cluster_without_a_shared_folder_is_refused():
    from types import SimpleNamespace

    import pytest

    from tallyproof.session import shared_folder

    nowhere = SimpleNamespace(get=lambda key, default=None: default)
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]"):
        context = SimpleNamespace(master=master, getCheckpointDir=lambda: None)
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            shared_folder(SimpleNamespace(conf=nowhere, sparkContext=context))


def test_quartiles_of_a_hot_pair_never_meet_in_one_place(spark):
    from tallyproof.operators.transfers import interval_features

    # one pair holds 200,000 distinct gaps, the others a few with ties
    gaps = spark.range(200_000).select(
        F.lit("hot").alias("address"), F.lit("t").alias("token"), (F.col("id") * 3 + 1).alias("gap")
    )
    few = {"a": [5], "b": [0, 7], "c": [0, 0, 4], "d": [9, 1, 4, 4], "e": [2, 2, 2, 8, 100, 0]}
    rows = [(k, "t", g) for k, v in few.items() for g in v]
    gaps = gaps.unionByName(spark.createDataFrame(rows, "address string, token string, gap long"))
    features = interval_features(gaps)
    assert "percentile" not in plan(features).lower()
    got = {r["address"]: (r.median_quarter_seconds, r.iqr_median_bps, r.gap_count) for r in features.collect()}
    values = {**few, "hot": [3 * i + 1 for i in range(200_000)]}
    for address, own in values.items():
        own = sorted(own)

        def quarters(k, own=own):
            low, rest = divmod((len(own) - 1) * k, 4)
            return own[low] * (4 - rest) + own[min(low + 1, len(own) - 1)] * rest

        middle = quarters(2)
        spread = (quarters(3) - quarters(1)) * 10_000 // middle if middle else None
        assert got[address] == (middle, spread, len(own))


# ---- what passes through the driver ----------------------------------------------------------


def test_summaries_of_ordered_scans_are_not_broadcast(spark):
    """A file's size says little about a summary of it, which grows with keys and segments."""
    rows = tables.frozen_relation(
        spark.range(4000).selectExpr("id % 7 AS k", "id AS at", "id AS v"), "scan"
    )
    segment = F.floor(F.col("at") / 100)
    carried = carry(
        rows, ["k"], segment, ["at"], Carry("v", "before", include_current=False)
    )
    summed = running_total(rows, ["k"], segment, ["at"], F.lit(1), "n")
    for df in (carried, summed):
        assert "Broadcast" not in plan(df)
    assert carried.where("before IS DISTINCT FROM CASE WHEN at >= 7 THEN at - 7 END").count() == 0
    assert summed.where("n <> at div 7 + 1").count() == 0


def test_sparse_values_are_carried_like_others(spark):
    rows = spark.range(3000).selectExpr("id % 5 AS k", "id AS at", "if(id % 97 = 3, id, null) AS v")
    segment = F.floor(F.col("at") / 50)
    specs = [Carry("v", "before", include_current=False), Carry("v", "after", backward=True)]
    plain = carry(rows, ["k"], segment, ["at"], *specs)
    sparse = carry(rows, ["k"], segment, ["at"], *specs, sparse=True)
    assert sparse.count() == 3000
    assert sparse.exceptAll(plain).count() == 0


# ---- what is computed and stored once --------------------------------------------------------


def test_stored_trades_are_lines_whose_unused_columns_are_not_derived(spark):
    with stored_copies(spark):
        stored = fees.stored_trades(spark, FOLDER)
        fresh = td.trades(spark, FOLDER)
        assert stored.columns == fresh.columns
        shown = [c for c in stored.columns if c != "discount"]
        assert stored.select(*shown).exceptAll(fresh.select(*shown)).count() == 0
        schema = plan(stored.select("tx_hash")).split("ReadSchema: ")[1].splitlines()[0]
        assert schema == "struct<l_orderkey:bigint>"


def test_points_of_a_lookup_are_computed_once(spark):
    with stored_copies(spark) as made:
        t = fees.stored_trades(spark, FOLDER)
        rows = intervals.interval_lookup(t, fees.points(spark, FOLDER), ["pool"], td.ORDER, fees.seg())
        assert sum("tallyproof-points-" in path for path in made) == 1
        assert "orders.parquet" not in plan(rows)


@pytest.mark.parametrize("name", ["replace_partitions", "backfill"])
def test_trades_are_stored_once_per_run(spark, name):
    with stored_copies(spark) as made:
        assert fees.QUERIES[name](spark, FOLDER).count() > 0
        assert sum("tallyproof-lines-" in path for path in made) == 1


def test_the_audit_reads_both_of_its_sides_from_one_store(spark):
    with stored_copies(spark) as made:
        rows = fees.QUERIES["price_coverage_audit"](spark, FOLDER)
        assert sum("tallyproof-lines-" in path for path in made) == 1
        assert "lineitem.parquet" not in plan(rows)
        assert rows.where("matched_rows > 0").count() > 0


def test_prices_out_of_scope_are_neither_aggregated_nor_moved(spark):
    with stored_copies(spark):
        t = fees.stored_trades(spark, FOLDER)
        prices = td.token_prices(t)
        scoped = enrich.scoped_prices(t, prices, fees.in_scope())
        text = plan(scoped)
        assert text.index("LeftSemi") > text.index("Exchange")
        sold = {r[0] for r in t.where(fees.in_scope()).select("token_sold").distinct().collect()}
        want = prices.where(F.col("asset").isin([asset for asset in sold if asset is not None]))
        assert scoped.exceptAll(want.select(*scoped.columns)).count() == 0
        assert scoped.count() == want.count() > 0


def test_entities_with_few_rows_are_scanned_without_segments(spark, monkeypatch):
    rows = spark.range(4000).selectExpr(
        "if(id % 3 = 0, 0, id % 11) AS k", "id AS at", "id AS fact", "id % 2 AS odd"
    )
    facts = tables.frozen_relation(rows.where("odd = 0 OR at % 35 = 0").drop("odd"), "facts")
    points = rows.where("at % 7 = 0").select("k", "at", F.col("fact").alias("state"))
    looked = []
    for limit in (1 << 18, 100):
        monkeypatch.setattr(intervals, "WHOLE_ENTITY_ROWS", limit)
        looked.append(intervals.interval_lookup(
            facts, points, ["k"], ["at"], F.floor(F.col("at") / 50), "fill", sized_by=facts
        ))
    whole, cut = looked
    assert "Join" not in plan(whole)
    assert "SortMergeJoin" in plan(cut)
    assert whole.count() == cut.count() > 0
    assert whole.exceptAll(cut).count() == 0


@pytest.mark.parametrize("name", ["manifest_pack", "adjacent_windows"])
def test_transfers_of_a_screen_are_derived_once(spark, name):
    with stored_copies(spark) as made:
        rows = screens.QUERIES[name](spark, FOLDER)
        assert sum("tallyproof-transfers-" in path for path in made) == 1
        if name == "adjacent_windows":
            assert "event_type" not in plan(rows)
        assert rows.count() > 0


def test_first_fundings_of_a_screen_are_found_once(spark):
    with stored_copies(spark) as made:
        rows = screens.QUERIES["activity_screen"](spark, FOLDER)
        assert sum("tallyproof-funding-" in path for path in made) == 1
        assert "first_block_number" not in plan(rows)
        assert rows.count() > 0
