"""Registered queries of the fee model, with their DuckDB twins."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyproof.functions import formulas as fx
from tallyproof.functions.decimals import exact_decimals, six_dp, usd
from tallyproof.operators import audit, digests, enrich, intervals, reconcile
from tallyproof.plans import fee_model as fm
from tallyproof.plans import parity, refresh
from tallyproof.registry.views import with_views
from tallyproof.session import fresh_path
from tallyproof.sources import scans, tables
from tallyproof.sources import testdata as td

QUERIES = {}
ORACLES = {}
WINDOW = (datetime(1996, 1, 1), datetime(2001, 1, 1))
KEY = td.EVENT_KEY
START, TODAY = date(1995, 1, 1), date(2030, 1, 1)


def query(name: str, oracle: str | None = None, extra: dict[str, str] | None = None):
    """Register a Spark query and, if given, its twin."""
    def add(function):
        QUERIES[name] = function
        if oracle is not None:
            ORACLES[name] = with_views(oracle, extra)
        return function
    return add


def seg() -> Column:
    return td.segment_of(F.col("block_number"))


def in_scope() -> Column:
    return F.col("pool") == td.TARGET_POOL


def points(spark: SparkSession, d: str) -> DataFrame:
    return fm.fee_points(td.pools(spark, d), td.settings(spark, d))


def stored_trades(spark: SparkSession, d: str) -> DataFrame:
    """Deduplicated trades as a table, for queries that read them several times.

    The lines are stored and their trade columns derived at each read, which costs less than to
    write and read decimals of columns that the query does not use.
    """
    return td.as_trades(tables.frozen_relation(td.unique_lines(spark, d), "lines"))


def model_rows(spark: SparkSession, d: str, strategy: str = "auto") -> DataFrame:
    t = stored_trades(spark, d)
    return fm.fee_rows(
        t, td.pools(spark, d), td.settings(spark, d), td.token_prices(t), in_scope(), seg(), "day",
        strategy, window=(td.FIRST_DAY, td.LAST_DAY),
    )


def whole_price_valued(spark: SparkSession, d: str, t: DataFrame | None = None) -> DataFrame:
    t = stored_trades(spark, d) if t is None else t
    return enrich.valued_rows(t, td.token_prices(t), "day")


# ---- scans, sources, sinks ------------------------------------------------------------------

SCAN_SQL = """
SELECT block_date, tx_hash, evt_index, pool, token_sold, amount_usd FROM trades_all
WHERE blockchain = 'chain_a' AND project = 'amm' AND version = 'F'
  AND block_time >= TIMESTAMP '1996-01-01' AND block_time < TIMESTAMP '2001-01-01'"""
SCAN_COLUMNS = {
    c: c for c in ("block_date", "tx_hash", "evt_index", "pool", "token_sold", "amount_usd")
}


@query("window_scan", SCAN_SQL)
def window_scan(spark, d):
    dims = {**td.CHAIN, "version": "F"}
    return scans.window_scan(td.trades_all(spark, d), dims, "block_time", *WINDOW, SCAN_COLUMNS)


def month_table(spark: SparkSession, d: str) -> DataFrame:
    """Undeduplicated trades stored by month, as a curated table would be."""
    rows = td.trades_all(spark, d).withColumn("block_month", F.trunc("block_date", "month"))
    path = fresh_path(spark, "trades")
    tables.trade_sink(rows, path, rows.columns, "block_month")
    return tables.read_table(spark, path)


@query("partition_pruned_scan", SCAN_SQL)
def partition_pruned_scan(spark, d):
    dims = {**td.CHAIN, "version": "F"}
    return scans.partition_pruned_scan(
        month_table(spark, d), dims, "block_time", *WINDOW, SCAN_COLUMNS, "block_month"
    )


TRADE_SQL = """
SELECT blockchain, project, version, block_date, block_number, tx_hash, evt_index, pool, token_sold,
  CAST(source_amount_usd AS DECIMAL(38,6)) AS source_amount_usd,
  CAST(round(fee_base_usd, 6) AS DECIMAL(38,6)) AS fee_base_usd, is_repaired, reason_code,
  fee_tier, fee_divisor, CAST(round(fees_usd, 6) AS DECIMAL(38,6)) AS fees_usd,
  CAST(round(revenue_usd, 6) AS DECIMAL(38,6)) AS revenue_usd,
  CAST(round(supply_side_fees_usd, 6) AS DECIMAL(38,6)) AS supply_side_fees_usd FROM fee_rows"""


def published(rows: DataFrame) -> DataFrame:
    money = ["source_amount_usd", "fee_base_usd", *parity.MEASURES]
    shown = [c for c in fm.TRADE_COLUMNS if c != "block_time"]
    return rows.select(*[six_dp(F.col(c)).alias(c) if c in money else F.col(c) for c in shown])


@query("trade_sink", TRADE_SQL)
def trade_sink(spark, d):
    path = tables.trade_sink(model_rows(spark, d), fresh_path(spark, "sink"), fm.TRADE_COLUMNS)
    return published(tables.read_table(spark, path))


@query("frozen_relation", """
SELECT row_number() OVER (ORDER BY block_number, evt_index, tx_hash) AS affected_row_number,
  block_number, tx_hash, evt_index, fixed_6 AS fixed_fee_base_usd_6, reason_code FROM affected""")
def frozen_relation(spark, d):
    return frozen_affected(stored_trades(spark, d))


def frozen_affected(t: DataFrame) -> DataFrame:
    window = (td.FIRST_DAY, td.LAST_DAY)
    rows = fm.affected_rows(t, td.token_prices(t), in_scope(), seg(), "day", window)
    kept = ["affected_row_number", "block_number", "tx_hash", "evt_index", "fixed_fee_base_usd_6",
            "reason_code"]
    return tables.frozen_relation(rows.select(*kept), "affected")


CONTRACT = T.StructType(
    [
        T.StructField("blockchain", T.StringType()),
        T.StructField("block_date", T.DateType()),
        T.StructField("tx_hash", T.LongType()),
        T.StructField("evt_index", T.IntegerType()),
        T.StructField("amount_usd", T.DecimalType(18, 6)),
        T.StructField("gas_used", T.LongType()),
    ]
)


@query("schema_contract", """
SELECT column_name, expected_type, live_type, status, CASE column_name WHEN 'blockchain' THEN b
 WHEN 'block_date' THEN d WHEN 'tx_hash' THEN t WHEN 'evt_index' THEN e WHEN 'amount_usd' THEN a
 WHEN 'pool' THEN p END AS value_rows
FROM (VALUES
 ('blockchain','string','string','OK'), ('block_date','date','date','OK'),
 ('tx_hash','bigint','bigint','OK'), ('evt_index','int','bigint','TYPE_CHANGED'),
 ('amount_usd','decimal(18,6)','decimal(18,6)','OK'), ('gas_used','bigint',NULL,'MISSING'),
 ('pool',NULL,'bigint','EXTRA')) v(column_name, expected_type, live_type, status),
(SELECT count(blockchain) AS b, count(block_date) AS d, count(tx_hash) AS t, count(evt_index) AS e,
  count(amount_usd) AS a, count(pool) AS p FROM trades_all)""")
def schema_contract(spark, d):
    live = td.trades_all(spark, d).select(
        "blockchain", "block_date", "tx_hash", "evt_index", "amount_usd", "pool"
    )
    return scans.schema_contract(live, CONTRACT)


@query("source_inventory", """
SELECT 'trades' AS source, count(*) AS row_count, CAST(min(l_shipdate) AS DATE) AS first_date,
  CAST(max(l_shipdate) AS DATE) AS last_date FROM lineitem
UNION ALL SELECT 'settings', count(*), CAST(min(o_orderdate) AS DATE),
  CAST(max(o_orderdate) AS DATE) FROM orders
UNION ALL SELECT 'prices', count(*), min(bucket), max(bucket) FROM prices
UNION ALL SELECT 'trades_with_price', count(*), min(t.block_date), max(t.block_date)
  FROM trades t JOIN prices p ON p.asset = t.token_sold AND p.bucket = t.block_date""")
def source_inventory(spark, d):
    priced = whole_price_valued(spark, d).where(F.col("input_price").isNotNull())
    changes = td.table(spark, d, "orders")
    return scans.source_inventory(
        {
            "trades": (td.trades_all(spark, d), "block_time"),
            "settings": (changes, "o_orderdate"),
            "prices": (td.prices(spark, d), "bucket"),
            "trades_with_price": (priced, "block_time"),
        }
    )


@query("price_coverage_audit", """
SELECT v.block_date, count(*) AS computed_rows, count_if(c.tx_hash IS NOT NULL) AS matched_rows,
  count_if(v.fixed_fee_base_usd IS NULL) AS missing_price_rows,
  count_if(c.tx_hash IS NULL) AS missing_curated_rows,
  CAST(round(coalesce(sum(v.fixed_fee_base_usd - CAST(c.amount_usd AS DECIMAL(38,18))),
    CAST(0 AS DECIMAL(38,18))), 6) AS DECIMAL(38,6)) AS amount_gap_usd
FROM valued_all v LEFT JOIN (SELECT tx_hash, evt_index, amount_usd FROM trades WHERE version = 'F') c
  ON v.tx_hash = c.tx_hash AND v.evt_index = c.evt_index GROUP BY v.block_date""")
def price_coverage_audit(spark, d):
    t = stored_trades(spark, d)
    computed = whole_price_valued(spark, d, t).withColumn("amount", F.col("fixed_fee_base_usd"))
    curated = t.where(F.col("version") == "F")
    curated = curated.withColumn("amount", F.col("amount_usd"))
    return scans.price_coverage_audit(computed, curated, KEY, "amount")


# ---- formulas -------------------------------------------------------------------------------

FORMULA_SQL = "SELECT tx_hash, evt_index, {} FROM fee_rows"


def six(expr: str, name: str) -> str:
    return f"CAST(round({expr}, 6) AS DECIMAL(38,6)) AS {name}"


@query("fee_from_ppm", FORMULA_SQL.format(f"fee_tier, {six('fees_usd', 'fees_usd')}"))
def fee_from_ppm(spark, d):
    return model_rows(spark, d).select(*KEY, "fee_tier", six_dp(F.col("fees_usd")).alias("fees_usd"))


@query("revenue_from_divisor",
       FORMULA_SQL.format("fee_divisor, revenue_usd"))
def revenue_from_divisor(spark, d):
    return model_rows(spark, d).select(*KEY, "fee_divisor", "revenue_usd")


@query("side_selector", """
SELECT tx_hash, evt_index, CASE WHEN token_sold = token0 THEN feeprotocol0
  WHEN token_sold = token1 THEN feeprotocol1 END AS fee_divisor FROM looked_up""")
def side_selector(spark, d):
    rows = looked_up(spark, d)
    side = fx.side_selector(*[F.col(c) for c in (
        "token_sold", "token0", "token1", "feeprotocol0", "feeprotocol1")])
    return rows.select(*KEY, side.alias("fee_divisor"))


@query("input_side_value", "SELECT tx_hash, evt_index, fixed_fee_base_usd FROM valued_all")
def input_side_value(spark, d):
    return whole_price_valued(spark, d).select(*KEY, "fixed_fee_base_usd")


@query("six_dp_compare", """
SELECT tx_hash, evt_index, legacy_6, fixed_6, legacy_6 IS DISTINCT FROM fixed_6 AS is_different,
  CAST(fixed_6 - legacy_6 AS DECIMAL(38,6)) AS delta_usd, pct AS difference_pct
FROM compared_all""")
def six_dp_compare(spark, d):
    legacy, fixed = F.col("legacy_fee_base_usd"), F.col("fixed_fee_base_usd")
    old, new = six_dp(legacy), six_dp(fixed)
    return whole_price_valued(spark, d).select(
        *KEY, old.alias("legacy_6"), new.alias("fixed_6"),
        fx.differs(old, new).alias("is_different"),
        (new - old).cast("decimal(38,6)").alias("delta_usd"),
        fx.percent_difference(legacy, fixed).alias("difference_pct"),
    )


@query("reason_code_model", """
SELECT tx_hash, evt_index, CASE WHEN pct > 100.0 THEN 'FEE_BASE_INPUT_SIDE_REVALUATION_GT_100PCT'
  ELSE 'FEE_BASE_INPUT_SIDE_REVALUATION' END AS reason_code
FROM compared_all WHERE fixed_fee_base_usd IS NOT NULL AND legacy_6 IS DISTINCT FROM fixed_6""")
def reason_code_model(spark, d):
    legacy, fixed = F.col("legacy_fee_base_usd"), F.col("fixed_fee_base_usd")
    rows = whole_price_valued(spark, d).where(fx.changed_at_six_dp(legacy, fixed))
    return rows.select(*KEY, fx.reason_code_model(legacy, fixed).alias("reason_code"))


STRICT_SQL = """
SELECT *, CASE WHEN fixed_6 <> 0 AND abs(legacy_6 - fixed_6) > abs(fixed_6)
  THEN 'FEE_BASE_INPUT_SIDE_REVALUATION_GT_100PCT'
  ELSE 'FEE_BASE_INPUT_SIDE_REVALUATION' END AS strict_code
FROM compared_all WHERE legacy_6 <> fixed_6"""


@query("reason_code_strict", "SELECT tx_hash, evt_index, strict_code AS reason_code FROM strict",
       {"strict": STRICT_SQL})
def reason_code_strict(spark, d):
    t = td.trades(spark, d)
    rows = fm.actual_changed(t, td.token_prices(t), F.lit(True), "day")
    return rows.select(*KEY, "reason_code")


@query("two_leg_valuation", """
SELECT tx_hash, evt_index, sold_usd, bought_usd, CASE WHEN amount_usd IS NULL THEN 'UNPRICED'
  WHEN coalesce(src = s6, false) AND coalesce(src = b6, false) THEN 'BOTH'
  WHEN coalesce(src = s6, false) THEN 'SOLD' WHEN coalesce(src = b6, false) THEN 'BOUGHT'
  ELSE 'NEITHER' END AS matched_leg
FROM (SELECT *, CAST(round(sold_usd, 6) AS DECIMAL(38,6)) AS s6,
   CAST(round(bought_usd, 6) AS DECIMAL(38,6)) AS b6, CAST(amount_usd AS DECIMAL(38,6)) AS src
  FROM (SELECT t.tx_hash, t.evt_index, t.amount_usd,
    CAST(CAST(t.token_sold_amount AS DECIMAL(38,6)) * CAST(s.price AS DECIMAL(20,8))
      AS DECIMAL(38,18)) AS sold_usd,
    CAST(CAST(t.token_bought_amount AS DECIMAL(38,6)) * CAST(b.price AS DECIMAL(20,8))
      AS DECIMAL(38,18)) AS bought_usd
   FROM trades t LEFT JOIN prices s ON s.asset = t.token_sold AND s.bucket = t.block_date
    LEFT JOIN prices b ON b.asset = t.token_bought AND b.bucket = t.block_date))""")
def two_leg_valuation(spark, d):
    t = td.trades(spark, d)
    rows = enrich.two_leg_valuation(t, td.token_prices(t), "day")
    return rows.select(*KEY, "sold_usd", "bought_usd", "matched_leg")


SWAP_SQL = {
    "decoded": """
SELECT tx_hash, evt_index, part_key, pool, token_sold = 2 * pool AS sold_is_token0,
  CAST(CAST(token_sold_amount AS DECIMAL(18,0)) * 1000000 AS DECIMAL(38,0)) AS sold_raw,
  CAST(CAST(token_bought_amount AS DECIMAL(18,0)) * 1000000 AS DECIMAL(38,0)) AS bought_raw
FROM trades WHERE token_sold IS NOT NULL""",
    "swaps": """
SELECT tx_hash, evt_index,
  CASE WHEN sold_is_token0 THEN sold_raw + (CASE WHEN part_key % 71 = 0 THEN 1 ELSE 0 END)
    ELSE (CASE WHEN part_key % 73 = 0 THEN 1 ELSE -1 END) * bought_raw END AS amount0,
  CASE WHEN sold_is_token0 THEN (CASE WHEN part_key % 73 = 0 THEN 1 ELSE -1 END) * bought_raw
    ELSE sold_raw + (CASE WHEN part_key % 71 = 0 THEN 1 ELSE 0 END) END AS amount1
FROM decoded WHERE part_key % 79 <> 0""",
}


def swap_pair(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Decoded trades and raw signed swaps with seeded gaps, amounts and directions."""
    def raw(c: str):
        return (F.col(c).cast("decimal(18,0)") * 1000000).cast("decimal(38,0)")

    part = F.col("part_key")
    decoded = td.trades(spark, d).where(F.col("token_sold").isNotNull()).select(
        *KEY, "part_key", (F.col("token_sold") == 2 * F.col("pool")).alias("sold_is_token0"),
        raw("token_sold_amount").alias("token_sold_amount_raw"),
        raw("token_bought_amount").alias("token_bought_amount_raw"),
    )
    entering = F.col("token_sold_amount_raw") + F.when(part % 71 == 0, 1).otherwise(0)
    leaving = F.col("token_bought_amount_raw") * F.when(part % 73 == 0, 1).otherwise(-1)
    zero_side = F.col("sold_is_token0")
    swaps = decoded.where(part % 79 != 0).select(
        *KEY,
        F.when(zero_side, entering).otherwise(leaving).cast("decimal(38,0)").alias("amount0"),
        F.when(zero_side, leaving).otherwise(entering).cast("decimal(38,0)").alias("amount1"),
    )
    return decoded, swaps


@query("raw_direction_check", """
SELECT tx_hash, evt_index, amount0 IS NOT NULL AS has_raw,
  entered IS NOT DISTINCT FROM sold_raw AS sold_matches,
  -leaving IS NOT DISTINCT FROM bought_raw AS bought_matches,
  coalesce(entered > 0 AND leaving < 0, false) AS direction_agrees
FROM (SELECT d.*, s.amount0, CASE WHEN sold_is_token0 THEN amount0 ELSE amount1 END AS entered,
   CASE WHEN sold_is_token0 THEN amount1 ELSE amount0 END AS leaving
  FROM decoded d LEFT JOIN swaps s ON d.tx_hash = s.tx_hash AND d.evt_index = s.evt_index)""",
       SWAP_SQL)
def raw_direction_check(spark, d):
    decoded, swaps = swap_pair(spark, d)
    return enrich.raw_direction_check(decoded, swaps, KEY).select(
        *KEY, "has_raw", "sold_matches", "bought_matches", "direction_agrees"
    )


# ---- state history and lookup ---------------------------------------------------------------

POINT_COLUMNS = "pool, block_number, evt_index, fee_tier, feeprotocol0, feeprotocol1"


@query("state_points", f"SELECT {POINT_COLUMNS} FROM points")
def state_points(spark, d):
    return points(spark, d).select(*POINT_COLUMNS.split(", "))


@query("state_intervals",
       f"SELECT {POINT_COLUMNS}, next_block_number, next_evt_index FROM intervals")
def state_intervals(spark, d):
    rows = intervals.state_intervals(points(spark, d), ["pool"], td.ORDER, seg())
    return rows.select(*POINT_COLUMNS.split(", "), "next_block_number", "next_evt_index")


def looked_up(spark: SparkSession, d: str, strategy: str = "fill") -> DataFrame:
    return intervals.interval_lookup(
        td.trades(spark, d), points(spark, d), ["pool"], td.ORDER, seg(), strategy
    )


@query("interval_lookup", """
SELECT tx_hash, evt_index, pool, block_number, fee_tier, feeprotocol0, feeprotocol1
FROM looked_up""")
def interval_lookup(spark, d):
    return looked_up(spark, d).select(
        *KEY, "pool", "block_number", "fee_tier", "feeprotocol0", "feeprotocol1"
    )


@query("candidate_entities", """
SELECT pool, token0, token1, fee_tier FROM pools
WHERE pool IN (SELECT pool FROM trades WHERE block_date >= DATE '2001-11-01')""")
def candidate_entities(spark, d):
    late = td.trades(spark, d).where(F.col("block_date") >= F.lit(date(2001, 11, 1)))
    kept = intervals.candidate_entities(td.pools(spark, d), late, "pool")
    return kept.select("pool", "token0", "token1", "fee_tier")


@query("minute_price_join", "SELECT tx_hash, evt_index, token_sold, input_price FROM valued_all")
def minute_price_join(spark, d):
    t = td.trades(spark, d)
    rows = enrich.minute_price_join(
        t, td.token_prices(t), "token_sold", "block_time", {"price": "input_price"}, "day"
    )
    return rows.select(*KEY, "token_sold", "input_price")


@query("repair_overlay", """
SELECT t.tx_hash, t.evt_index, coalesce(a.fixed_fee_base_usd, CAST(t.amount_usd AS DECIMAL(38,18)))
  AS fee_base_usd, a.tx_hash IS NOT NULL AS is_repaired, a.reason_code
FROM trades t LEFT JOIN affected a ON t.block_number = a.block_number AND t.tx_hash = a.tx_hash
  AND t.evt_index = a.evt_index AND t.pool = a.pool""")
def repair_overlay(spark, d):
    t = td.trades(spark, d)
    repairs = enrich.accepted_repairs(
        enrich.valued_rows(t.where(in_scope()), td.token_prices(t), "day")
    )
    rows = enrich.repair_overlay(t, repairs, td.REPAIR_KEY)
    return rows.select(*KEY, "fee_base_usd", "is_repaired", "reason_code")


# ---- keys and coverage ----------------------------------------------------------------------

SIDES_SQL = {
    "side_a": "SELECT tx_hash, evt_index FROM trades_all WHERE part_key % 31 <> 0",
    "side_b": "SELECT tx_hash, evt_index FROM trades_all WHERE part_key % 37 <> 0",
    "counts": """
SELECT a.n AS l, b.n AS r FROM (SELECT tx_hash, evt_index, count(*) n FROM side_a GROUP BY ALL) a
FULL JOIN (SELECT tx_hash, evt_index, count(*) n FROM side_b GROUP BY ALL) b
  ON a.tx_hash = b.tx_hash AND a.evt_index = b.evt_index""",
}


def two_sides(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """The whole raw trades with two different seeded losses."""
    rows = td.trades_all(spark, d)
    return rows.where(F.col("part_key") % 31 != 0), rows.where(F.col("part_key") % 37 != 0)


@query("key_coverage", """
SELECT count_if(l IS NOT NULL AND r IS NOT NULL) AS matched_keys,
  count_if(r IS NULL) AS left_only_keys, count_if(l IS NULL) AS right_only_keys FROM counts""",
       SIDES_SQL)
def key_coverage(spark, d):
    return reconcile.key_coverage(*two_sides(spark, d), KEY)


@query("key_multiset_coverage", """
SELECT count_if(l IS NOT NULL AND r IS NOT NULL) AS matched_keys,
  count_if(r IS NULL) AS left_only_keys, count_if(l IS NULL) AS right_only_keys,
  count_if(l <> r) AS row_count_mismatch_keys FROM counts""", SIDES_SQL)
def key_multiset_coverage(spark, d):
    return reconcile.key_multiset_coverage(*two_sides(spark, d), KEY)


@query("dedupe_by_key", "SELECT tx_hash, evt_index, part_key, pool, list_usd FROM trades")
def dedupe_by_key(spark, d):
    rows = reconcile.dedupe_by_key(td.trades_all(spark, d), KEY, ["part_key", "pool", "list_usd"])
    return rows.select(*KEY, "part_key", "pool", "list_usd")


@query("key_audit", """
SELECT count(*) AS row_count, count(DISTINCT (tx_hash, evt_index)) AS distinct_keys,
  count(*) - count(DISTINCT (tx_hash, evt_index)) AS duplicate_surplus_rows,
  count_if(tx_hash IS NULL OR evt_index IS NULL) AS null_key_rows,
  count_if(amount_usd IS NULL) AS unpriced_rows FROM trades_all""")
def key_audit(spark, d):
    return reconcile.key_audit(td.trades_all(spark, d), KEY, "amount_usd")


# ---- rollups --------------------------------------------------------------------------------

ROLLUP_SQL = """count(*) AS trade_rows, count_if(is_repaired) AS repaired_rows,
  count_if(reason_code = 'FEE_BASE_INPUT_SIDE_REVALUATION') AS ordinary_repaired_rows,
  count_if(reason_code = 'FEE_BASE_INPUT_SIDE_REVALUATION_GT_100PCT') AS material_repaired_rows,
  count_if(fee_base_usd IS NULL) AS unpriced_fee_base_rows,
  count_if(is_repaired AND fee_base_usd IS NULL) AS repaired_null_rows,
  CAST(round(sum(fees_usd), 6) AS DECIMAL(38,6)) AS fees_usd,
  CAST(round(sum(fees_usd) - sum(revenue_usd), 6) AS DECIMAL(38,6)) AS supply_side_fees_usd,
  CAST(round(sum(revenue_usd), 6) AS DECIMAL(38,6)) AS revenue_usd,
  CAST(round(sum(fees_usd) - (sum(fees_usd) - sum(revenue_usd)) - sum(revenue_usd), 6)
    AS DECIMAL(38,6)) AS accounting_residual_usd"""


@query("metric_rollup", f"SELECT version, {ROLLUP_SQL} FROM fee_rows GROUP BY version")
def metric_rollup(spark, d):
    return fm.metric_rollup(model_rows(spark, d), ["version"])


@query("supply_side_rows", TRADE_SQL)
def supply_side_rows(spark, d):
    return published(fm.supply_side_rows(model_rows(spark, d).drop("supply_side_fees_usd")))


@query("state_event_partition", """
SELECT count_if(n = 0) AS zero_event_entities, count_if(n = 1) AS one_event_entities,
  count_if(n > 1) AS multiple_event_entities, CAST(sum(n) AS BIGINT) AS state_events,
  (SELECT count(*) - count(DISTINCT (pool, block_number, evt_index)) FROM settings)
    AS duplicate_event_surplus,
  (SELECT count(DISTINCT pool) FROM settings WHERE pool NOT IN (SELECT pool FROM pools))
    AS orphan_entities,
  (SELECT count(DISTINCT pool) FROM pools)
    - count_if(n = 0) - count_if(n = 1) - count_if(n > 1) AS partition_residual
FROM (SELECT p.pool, count(s.pool) AS n FROM pools p LEFT JOIN settings s ON s.pool = p.pool
  GROUP BY p.pool)""")
def state_event_partition(spark, d):
    return fm.state_event_partition(td.pools(spark, d), td.settings(spark, d))


@query("numbered_affected", """
SELECT row_number() OVER (ORDER BY block_number, evt_index, tx_hash) AS affected_row_number,
  count(*) OVER () AS affected_row_count, block_number, tx_hash, evt_index, pool
FROM compared_all WHERE fixed_fee_base_usd IS NOT NULL AND legacy_6 IS DISTINCT FROM fixed_6""")
def numbered_affected(spark, d):
    rows = enrich.accepted_repairs(whole_price_valued(spark, d))
    kept = rows.select("block_number", "tx_hash", "evt_index", "pool")
    return fm.numbered_affected(kept, seg())


# ---- quality of the change set --------------------------------------------------------------

PROFILE_SQL = """
SELECT count(*) AS row_count,
  count_if(reason_code = 'FEE_BASE_INPUT_SIDE_REVALUATION') AS reason_0_rows,
  count_if(reason_code = 'FEE_BASE_INPUT_SIDE_REVALUATION_GT_100PCT') AS reason_1_rows,
  0::BIGINT AS unexpected_reason_rows, count_if(fixed_6 IS NULL) AS null_value_rows,
  1::BIGINT AS min_row_number, count(*) AS max_row_number, count(*) AS distinct_row_numbers,
  count(DISTINCT (tx_hash, evt_index)) AS distinct_keys,
  count(*) - count(DISTINCT (tx_hash, evt_index)) AS duplicate_surplus_rows FROM affected"""


@query("expected_set_profile", PROFILE_SQL)
def expected_set_profile(spark, d):
    return reconcile.expected_set_profile(
        frozen_affected(stored_trades(spark, d)), KEY, "fixed_fee_base_usd_6", "reason_code",
        "affected_row_number", [fx.ORDINARY, fx.MATERIAL],
    )


CHANGE_SQL = {
    "strict": STRICT_SQL,
    "actual": "SELECT tx_hash, evt_index, fixed_6, strict_code FROM strict WHERE pool = 7",
    "expected": "SELECT tx_hash, evt_index, fixed_6, reason_code FROM affected",
}


def change_sets(t: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Expected (stored) and independently rebuilt change set, one row per key."""
    actual = fm.actual_changed(t, td.token_prices(t), in_scope(), "day")
    order = ["block_number", "evt_index", "tx_hash"]
    return (
        reconcile.dedupe_by_key(frozen_affected(t), KEY, order),
        reconcile.dedupe_by_key(actual, KEY, order),
    )


DIFF_SQL = """
SELECT count_if(e.tx_hash IS NOT NULL AND a.tx_hash IS NOT NULL) AS matched_changed_rows,
  count_if(a.tx_hash IS NULL) AS missing_expected_rows,
  count_if(e.tx_hash IS NULL) AS unexpected_actual_changed_rows,
  count_if(e.tx_hash IS NOT NULL AND a.tx_hash IS NOT NULL
    AND e.fixed_6 IS DISTINCT FROM a.fixed_6) AS fixed_value_mismatch_rows,
  count_if(e.tx_hash IS NOT NULL AND a.tx_hash IS NOT NULL
    AND e.reason_code IS DISTINCT FROM a.strict_code) AS reason_code_mismatch_rows
FROM expected e FULL JOIN actual a ON e.tx_hash = a.tx_hash AND e.evt_index = a.evt_index"""


@query("changed_set_diff", DIFF_SQL, CHANGE_SQL)
def changed_set_diff(spark, d):
    return reconcile.changed_set_diff(
        *change_sets(stored_trades(spark, d)), KEY, "fixed_fee_base_usd_6", "reason_code"
    )


ROW_DIFF_SQL = """
SELECT count(*) AS model_rows, count_if(b IS DISTINCT FROM n) AS model_changed_rows,
  count_if(x AND b IS DISTINCT FROM n) AS changed_expected_rows,
  count_if(x AND b IS NOT DISTINCT FROM n) AS expected_rows_not_changed,
  count_if(NOT x AND b IS DISTINCT FROM n) AS changed_unaffected_rows,
  count_if(NOT x AND b IS NOT DISTINCT FROM n) AS unchanged_unaffected_rows,
  count_if(b IS NULL) AS before_null_rows, count_if(n IS NULL) AS after_null_rows,
  count_if(b IS NOT NULL AND n IS NULL) AS newly_null_rows,
  count_if(b IS NULL AND n IS NOT NULL) AS unexpectedly_filled_null_rows
FROM (SELECT CAST(t.amount_usd AS DECIMAL(38,6)) AS b, e.tx_hash IS NOT NULL AS x,
   CASE WHEN a.tx_hash IS NOT NULL THEN a.fixed_6 ELSE CAST(t.amount_usd AS DECIMAL(38,6)) END AS n
  FROM trades t LEFT JOIN actual a ON t.tx_hash = a.tx_hash AND t.evt_index = a.evt_index
   LEFT JOIN expected e ON t.tx_hash = e.tx_hash AND t.evt_index = e.evt_index)"""


def row_diff_of(t: DataFrame, sets: tuple[DataFrame, DataFrame]) -> DataFrame:
    expected, actual = sets
    base = t.select(*KEY, six_dp(usd(F.col("amount_usd"))).alias("before_usd"))
    return reconcile.row_diff(base, actual, expected, KEY, "before_usd", "fixed_fee_base_usd_6")


@query("row_diff", ROW_DIFF_SQL, CHANGE_SQL)
def row_diff(spark, d):
    t = stored_trades(spark, d)
    return row_diff_of(t, change_sets(t))


REGRESSION_CHECKS = {
    "base_has_unique_keys": "duplicate_surplus_rows = 0 AND null_key_rows = 0",
    "expected_set_is_numbered": "expected_row_count = expected_max_row_number",
    "no_missing_expected_row": "missing_expected_rows = 0",
    "no_unexpected_change": "unexpected_actual_changed_rows = 0",
    "values_agree": "fixed_value_mismatch_rows = 0",
    "reasons_agree": "reason_code_mismatch_rows = 0",
    "unaffected_rows_unchanged": "changed_unaffected_rows = 0",
    "no_newly_null_row": "newly_null_rows = 0",
    "no_filled_null_row": "unexpectedly_filled_null_rows = 0",
    "population_closes": "model_rows = row_count",
}


def regression_metrics(spark: SparkSession, d: str) -> DataFrame:
    """Base audit, set profile, set difference and population difference on one row."""
    t = stored_trades(spark, d)
    sets = change_sets(t)
    profile = reconcile.expected_set_profile(
        sets[0], KEY, "fixed_fee_base_usd_6", "reason_code", "affected_row_number",
        [fx.ORDINARY, fx.MATERIAL],
    )
    profile = profile.select(*[F.col(c).alias(f"expected_{c}") for c in profile.columns])
    return reconcile.beside(
        reconcile.key_audit(t, KEY, "amount_usd"),
        profile,
        reconcile.changed_set_diff(*sets, KEY, "fixed_fee_base_usd_6", "reason_code"),
        row_diff_of(t, sets),
    )


REGRESSION_SQL = {
    **CHANGE_SQL,
    "audit_row": """
SELECT count(*) AS row_count, count(DISTINCT (tx_hash, evt_index)) AS distinct_keys,
  count(*) - count(DISTINCT (tx_hash, evt_index)) AS duplicate_surplus_rows,
  count_if(tx_hash IS NULL OR evt_index IS NULL) AS null_key_rows,
  count_if(amount_usd IS NULL) AS unpriced_rows FROM trades""",
    "profile_row": "SELECT " + ", ".join(
        f"{c} AS expected_{c}" for c in (
            "row_count", "reason_0_rows", "reason_1_rows", "unexpected_reason_rows",
            "null_value_rows", "min_row_number", "max_row_number", "distinct_row_numbers",
            "distinct_keys", "duplicate_surplus_rows")) + f" FROM ({PROFILE_SQL})",
    "set_row": DIFF_SQL,
    "pop_row": ROW_DIFF_SQL,
    "regression_row": "SELECT * FROM audit_row, profile_row, set_row, pop_row",
}
ALL_CHECKS = " AND ".join(f"({c})" for c in REGRESSION_CHECKS.values())


@query("regression_gate", " UNION ALL ".join(
    f"SELECT '{n}' AS check_name, ({c}) AS passed, ({ALL_CHECKS}) AS all_checks_pass "
    "FROM regression_row" for n, c in REGRESSION_CHECKS.items()), REGRESSION_SQL)
def regression_gate(spark, d):
    return audit.regression_gate(regression_metrics(spark, d), REGRESSION_CHECKS)


@query("fee_regression",
       f"SELECT *, ({ALL_CHECKS}) AS all_checks_pass FROM regression_row", REGRESSION_SQL)
def fee_regression(spark, d):
    return audit.with_gate(regression_metrics(spark, d), REGRESSION_CHECKS, "all_checks_pass")


UNITS = {
    "trade_rows": "rows", "repaired_rows": "rows", "fees_usd": "USD",
    "supply_side_fees_usd": "USD", "revenue_usd": "USD", "display_rounding_residual_usd": "USD",
}

# Millionths of every metric, all in whole numbers.
IMPACT_SQL = {
    "before_units": """
SELECT count(*) AS n, 0 AS repaired, sum(f) AS fee, sum(CASE WHEN fee_divisor BETWEEN 4 AND 10
  THEN (2 * f + fee_divisor) // (2 * fee_divisor) ELSE 0 END) AS cut
FROM (SELECT fee_divisor,
  coalesce(CAST(amount_usd * 1000000 AS HUGEINT) * 1000000 * fee_tier, 0) AS f FROM money)""",
    "after_units": """
SELECT count(*) AS n, count_if(is_repaired) AS repaired, sum(fee) AS fee, sum(cut) AS cut
FROM shares""",
    "millionths": """
SELECT variant, 1000000 * n AS trade_rows, 1000000 * repaired AS repaired_rows,
  (fee + 500000000000) // 1000000000000 AS fees_usd,
  (fee - cut + 500000000000) // 1000000000000 AS supply_side_fees_usd,
  (cut + 500000000000) // 1000000000000 AS revenue_usd
FROM (SELECT 'b' AS variant, * FROM before_units UNION ALL SELECT 'a', * FROM after_units)""",
    "impact": " UNION ALL ".join(
        f"SELECT '{m}' AS metric, '{u}' AS unit, "
        f"max(CASE WHEN variant = 'b' THEN {v} END) AS b, max(CASE WHEN variant = 'a' THEN {v} END) AS a "
        "FROM millionths" for m, u in UNITS.items()
        for v in ["fees_usd - supply_side_fees_usd - revenue_usd" if m.startswith("display") else m]),
}


@query("impact_table", """
SELECT metric, unit,
  CAST(CAST(b AS DECIMAL(28,0)) * CAST(0.000001 AS DECIMAL(6,6)) AS DECIMAL(38,6)) AS before_value,
  CAST(CAST(a AS DECIMAL(28,0)) * CAST(0.000001 AS DECIMAL(6,6)) AS DECIMAL(38,6)) AS after_value,
  CAST(CAST(a - b AS DECIMAL(28,0)) * CAST(0.000001 AS DECIMAL(6,6)) AS DECIMAL(38,6))
    AS absolute_change,
  CASE WHEN b = 0 THEN 'not_applicable' ELSE CAST(CAST(sign(a - b) * sign(b) AS INTEGER)
    * CAST((2 * abs(a - b) * 1000000 + abs(b)) // (2 * abs(b)) AS DECIMAL(28,0))
    * CAST(0.0001 AS DECIMAL(5,4)) AS DECIMAL(28,4))::VARCHAR || '%' END AS percentage_change
FROM impact""", IMPACT_SQL)
def impact_table(spark, d):
    t = stored_trades(spark, d)
    rollup = fm.repair_impact(
        t, td.pools(spark, d), td.settings(spark, d), td.token_prices(t), in_scope(), seg(), "day"
    )
    return audit.impact_table(rollup, "variant", fm.LEGACY, fm.REPAIRED, UNITS)


@query("display_residual", """
SELECT version, shown AS display_residual_usd, exact AS unrounded_residual_usd,
  CASE WHEN shown <> 0 AND exact = 0 THEN 'DISPLAY_ROUNDING_6DP' WHEN exact = 0 THEN 'NONE'
    ELSE 'ACCOUNTING' END AS residual_class
FROM (SELECT version,
  CAST(CAST(round(sum(fees_usd), 6) AS DECIMAL(38,6))
   - CAST(round(sum(supply_side_fees_usd), 6) AS DECIMAL(38,6))
   - CAST(round(sum(revenue_usd), 6) AS DECIMAL(38,6)) AS DECIMAL(38,6)) AS shown,
  CAST(round(sum(fees_usd) - sum(supply_side_fees_usd) - sum(revenue_usd), 6)
   AS DECIMAL(38,6)) AS exact FROM fee_rows GROUP BY version)""")
def display_residual(spark, d):
    return audit.display_residual(model_rows(spark, d).groupBy("version"))


# ---- pipelines ------------------------------------------------------------------------------


@query("fee_model", f"SELECT {ROLLUP_SQL} FROM fee_rows")
def fee_model(spark, d):
    return fm.metric_rollup(model_rows(spark, d))


@query("affected_rows", """
SELECT row_number() OVER (ORDER BY block_number, evt_index, tx_hash) AS affected_row_number,
  count(*) OVER () AS affected_row_count, block_date, block_number, tx_hash, evt_index, pool,
  token_sold, token_bought, CAST(token_sold_amount AS DECIMAL(38,18)) AS token_sold_amount,
  CAST(token_bought_amount AS DECIMAL(38,18)) AS token_bought_amount,
  CAST(input_price AS DECIMAL(38,18)) AS input_token_price_usd, legacy_6 AS legacy_fee_base_usd_6,
  fixed_6 AS fixed_fee_base_usd_6, reason_code,
  CAST(fixed_6 - legacy_6 AS DECIMAL(38,6)) AS fee_base_delta_usd,
  CAST(round(pct, 4) AS DECIMAL(38,4)) AS absolute_difference_pct FROM affected""")
def affected_rows(spark, d):
    t = stored_trades(spark, d)
    window = (td.FIRST_DAY, td.LAST_DAY)
    return fm.affected_rows(t, td.token_prices(t), in_scope(), seg(), "day", window)


OVERLAP_SQL = {
    "overlap_start": "SELECT max(block_date) - 2 AS day FROM trades",
    "baseline_src": "SELECT * FROM trades WHERE block_time < TIMESTAMP '2030-01-01'",
}


def build_of(spark: SparkSession, d: str) -> refresh.Build:
    t = stored_trades(spark, d)
    return refresh.incremental_build(
        t, td.pools(spark, d), td.settings(spark, d), td.token_prices(t), in_scope(), seg(), "day"
    )


@query("tagged_paths", f"""
SELECT model_path, {ROLLUP_SQL} FROM (
 SELECT 'BASELINE' AS model_path, * FROM fee_rows
 UNION ALL SELECT 'OPTIMIZED_FULL_REFRESH', * FROM fee_rows) GROUP BY model_path""")
def tagged_paths(spark, d):
    return fm.metric_rollup(both_paths(spark, d, stored_trades(spark, d)), ["model_path"])


def path_sources(t: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The time-bounded and the date-bounded scan of one snapshot."""
    baseline = scans.window_scan(t, td.CHAIN, "block_time", td.FIRST_DAY, td.LAST_DAY)
    optimized = scans.partition_pruned_scan(
        t, td.CHAIN, "block_time", td.FIRST_DAY, td.LAST_DAY
    )
    return baseline, optimized


def both_paths(spark: SparkSession, d: str, t: DataFrame) -> DataFrame:
    return parity.two_paths(
        *path_sources(t), td.pools(spark, d), td.settings(spark, d), td.token_prices(t),
        in_scope(), seg(), "day",
    )


PARITY_SQL = {
    "src_row": """
SELECT count(*) AS n, count(DISTINCT (tx_hash, evt_index)) AS k FROM trades""",
    "fee_row": f"SELECT {ROLLUP_SQL} FROM fee_rows",
}


def _parity_select() -> str:
    out = []
    for s in ("baseline", "optimized"):
        out += [
            f"n AS source_{s}_rows", f"k AS source_{s}_distinct_keys",
            f"n - k AS source_{s}_duplicate_key_surplus_rows",
            f"trade_rows AS {s}_model_rows", f"repaired_rows AS {s}_repaired_rows",
            f"unpriced_fee_base_rows AS {s}_unpriced_fee_base_rows",
            f"repaired_null_rows AS {s}_repaired_null_rows",
            f"fees_usd AS {s}_fees_usd", f"revenue_usd AS {s}_revenue_usd",
            f"supply_side_fees_usd AS {s}_supply_side_fees_usd",
            f"accounting_residual_usd AS {s}_accounting_residual_usd",
        ]
    zero = ["source_baseline_only_keys", "source_optimized_only_keys",
            "source_row_count_mismatch_keys", "left_only_keys", "right_only_keys",
            "field_mismatch_keys"]
    out += [f"0::BIGINT AS {z}" for z in zero]
    out += [f"CAST(0 AS DECIMAL(38,6)) AS {m}_row_difference_sum" for m in parity.MEASURES]
    out += ["trade_rows AS matched_keys", "true AS same_snapshot_parity_pass"]
    return "SELECT " + ", ".join(out) + " FROM src_row, fee_row"


def parity_of(spark: SparkSession, d: str) -> DataFrame:
    t = stored_trades(spark, d)
    rows = tables.frozen_relation(both_paths(spark, d, t), "paths", "model_path")
    return parity.parity_report(rows, *path_sources(t))


@query("parity_report", _parity_select(), PARITY_SQL)
def parity_report(spark, d):
    return parity_of(spark, d)


@query("fee_parity", " UNION ALL ".join(
    f"SELECT '{n}' AS check_name, true AS passed, true AS same_snapshot_parity_pass"
    for n in parity.parity_expectations()))
def fee_parity(spark, d):
    report = parity_of(spark, d).drop("same_snapshot_parity_pass")
    return audit.regression_gate(
        report, parity.parity_expectations(), "same_snapshot_parity_pass"
    )


FIELD_SQL = {
    "l": "SELECT * FROM fee_rows",
    "rr": """
SELECT * REPLACE (CASE WHEN tx_hash % 43 = 0 THEN NULL ELSE fee_divisor END AS fee_divisor,
  CASE WHEN tx_hash % 47 = 0 THEN fees_usd + 1 ELSE fees_usd END AS fees_usd)
FROM fee_rows WHERE tx_hash % 41 <> 0""",
}


FIELD_MISMATCH_SQL = ("""
SELECT count_if(l.tx_hash IS NOT NULL AND rr.tx_hash IS NOT NULL) AS matched_keys,
  count_if(rr.tx_hash IS NULL) AS left_only_keys, count_if(l.tx_hash IS NULL) AS right_only_keys,
  count_if(l.tx_hash IS NOT NULL AND rr.tx_hash IS NOT NULL AND (
    l.fee_divisor IS DISTINCT FROM rr.fee_divisor OR l.fees_usd IS DISTINCT FROM rr.fees_usd))
    AS field_mismatch_keys, """ + ", ".join(
    f"count_if(l.tx_hash IS NOT NULL AND rr.tx_hash IS NOT NULL AND "
    f"l.{f} IS DISTINCT FROM rr.{f}) AS {f}_mismatch_keys" for f in parity.FIELDS) + ", " +
    ", ".join(f"CAST(round(sum(coalesce(l.{m}, CAST(0 AS DECIMAL(38,18))) - "
              f"coalesce(rr.{m}, CAST(0 AS DECIMAL(38,18)))), 6) AS DECIMAL(38,6)) "
              f"AS {m}_row_difference_sum" for m in parity.MEASURES) +
    " FROM l FULL JOIN rr ON l.tx_hash = rr.tx_hash AND l.evt_index = rr.evt_index")


@query("field_mismatch", FIELD_MISMATCH_SQL, FIELD_SQL)
def field_mismatch(spark, d):
    left = model_rows(spark, d)
    right = seeded_rows(left)
    return reconcile.field_mismatch(left, right, KEY, parity.FIELDS, parity.MEASURES)


@query("ranged_field_mismatch", FIELD_MISMATCH_SQL, FIELD_SQL)
def ranged_field_mismatch(spark, d):
    """The same counts, rows being paired only in ranges whose digests differ."""
    left = tables.frozen_relation(model_rows(spark, d), "model")
    right = seeded_rows(left)
    return digests.ranged_field_mismatch(
        left, right, "block_date", KEY, parity.FIELDS, parity.MEASURES
    )


RANGES_SQL = {
    "l": "SELECT * FROM fee_rows",
    "rr": """
SELECT * REPLACE (CASE WHEN tx_hash % 47 = 0 THEN fees_usd + 1 ELSE fees_usd END AS fees_usd)
FROM fee_rows WHERE tx_hash % 41 <> 0 OR month(block_date) <> 3""",
    "spots": """
SELECT coalesce(a.block_date, b.block_date) AS day, coalesce(a.tx_hash, b.tx_hash) % 16 AS bucket,
  a.tx_hash IS NOT NULL AS on_left, b.tx_hash IS NOT NULL AS on_right, a IS DISTINCT FROM b AS apart
FROM l a FULL JOIN rr b ON a.tx_hash = b.tx_hash AND a.evt_index = b.evt_index""",
    "per_range": """
SELECT day, bucket, count_if(on_left) AS n, count_if(on_right) AS m, bool_or(apart) AS hit
FROM spots GROUP BY day, bucket""",
}


@query("range_summary", """
SELECT day::VARCHAR AS part, count(*) AS ranges, CAST(sum(n) AS BIGINT) AS left_rows,
  CAST(sum(m) AS BIGINT) AS right_rows, count_if(hit) AS differing_ranges,
  CAST(sum(CASE WHEN hit THEN n + m ELSE 0 END) AS BIGINT) AS rows_to_compare
FROM per_range GROUP BY day""", RANGES_SQL)
def range_summary(spark, d):
    """Dates and key ranges of two snapshots, compared by digests alone."""
    left = tables.frozen_relation(model_rows(spark, d), "model")
    key, march = F.col("tx_hash"), F.month("block_date") == 3
    right = left.where((key % 41 != 0) | ~march).withColumn(
        "fees_usd",
        F.when(key % 47 == 0, usd(F.col("fees_usd") + 1)).otherwise(F.col("fees_usd")),
    )
    return digests.range_summary(
        left, right, F.col("block_date"), key % 16, KEY, parity.FIELDS
    )


def seeded_rows(rows: DataFrame) -> DataFrame:
    """A copy with lost rows, emptied divisors and changed fees."""
    key = F.col("tx_hash")
    return (
        rows.where(key % 41 != 0)
        .withColumn("fee_divisor", F.when(key % 43 != 0, F.col("fee_divisor")))
        .withColumn(
            "fees_usd",
            F.when(key % 47 == 0, usd(F.col("fees_usd") + 1)).otherwise(F.col("fees_usd")),
        )
    )


@query("scan_reduction", """
SELECT i AS input, f AS full_rows, r AS reduced_rows,
  CAST(((2000000 * CAST(f - r AS HUGEINT) + f) // (2 * f)) * CAST(0.0001 AS DECIMAL(5,4))
    AS DECIMAL(38,4)) AS reduction_pct
FROM (
 SELECT 'trades' AS i, count(*) AS f,
  count_if(block_date >= (SELECT day FROM overlap_start)) AS r FROM trades
 UNION ALL SELECT 'pools', count(*), count_if(pool IN (SELECT pool FROM trades
  WHERE block_date >= (SELECT day FROM overlap_start))) FROM pools
 UNION ALL SELECT 'settings', count(*), count_if(pool IN (SELECT pool FROM trades
  WHERE block_date >= (SELECT day FROM overlap_start))) FROM settings)""", OVERLAP_SQL)
def scan_reduction(spark, d):
    t, p, s = td.trades(spark, d), td.pools(spark, d), td.settings(spark, d)
    late = t.where(overlap_bounds(spark, d).on())
    return audit.scan_reduction(
        {
            "trades": (t, late),
            "pools": (p, intervals.candidate_entities(p, late, "pool")),
            "settings": (s, intervals.candidate_entities(s, late, "pool")),
        }
    )


def overlap_bounds(spark: SparkSession, d: str) -> refresh.Bounds:
    newest = td.trades_all(spark, d).agg(F.max("block_date")).first()[0]
    return refresh.refresh_bounds(START, TODAY, newest=newest)


@query("snapshot_drift", """
SELECT count_if(l.tx_hash IS NULL) AS added_rows, count_if(rr.tx_hash IS NULL) AS removed_rows,
  count_if(l.tx_hash IS NOT NULL AND rr.tx_hash IS NOT NULL AND (l.a IS DISTINCT FROM rr.a
    OR l.pool IS DISTINCT FROM rr.pool)) AS changed_rows,
  count_if(l.tx_hash IS NOT NULL AND rr.tx_hash IS NOT NULL AND l.a IS NOT DISTINCT FROM rr.a
    AND l.pool IS NOT DISTINCT FROM rr.pool) AS unchanged_rows,
  count_if(l.tx_hash IS NOT NULL AND l.a IS NULL AND rr.a IS NOT NULL) AS null_to_priced_rows,
  count_if(coalesce(rr.u > DATE '2001-01-01', false)) AS updated_after_freeze_rows
FROM (SELECT tx_hash, evt_index, pool, amount_usd AS a FROM trades WHERE part_key % 59 <> 0) l
FULL JOIN (SELECT tx_hash, evt_index, pool, block_date AS u,
  CASE WHEN amount_usd IS NULL AND part_key % 3 = 0 THEN list_usd
    WHEN part_key % 67 = 0 THEN amount_usd * 2 ELSE amount_usd END AS a
  FROM trades WHERE part_key % 53 <> 0) rr
 ON l.tx_hash = rr.tx_hash AND l.evt_index = rr.evt_index""")
def snapshot_drift(spark, d):
    t, part = td.trades(spark, d), F.col("part_key")
    before = t.where(part % 59 != 0).withColumn("updated", F.col("block_date"))
    later = (
        F.when(F.col("amount_usd").isNull() & (part % 3 == 0), F.col("list_usd"))
        .when(part % 67 == 0, F.col("amount_usd") * 2)
        .otherwise(F.col("amount_usd"))
        .cast("decimal(18,6)")
    )
    after = t.where(part % 53 != 0).withColumn("amount_usd", later)
    after = after.withColumn("updated", F.col("block_date"))
    return reconcile.snapshot_drift(
        before, after, KEY, ["amount_usd", "pool"], "amount_usd", "updated",
        F.lit(date(2001, 1, 1)),
    )


@query("external_metric_gap", """
SELECT o.block_month, o.own_fees_usd, e.published_fees_usd,
  CAST(own_fees_usd - published_fees_usd AS DECIMAL(38,6)) AS gap,
  CAST(CAST(sign(own_fees_usd - published_fees_usd) AS INTEGER) *
   CAST((2 * CAST(abs(own_fees_usd - published_fees_usd) * 1000000 AS HUGEINT) * 1000000
     + CAST(published_fees_usd * 1000000 AS HUGEINT))
     // (2 * CAST(published_fees_usd * 1000000 AS HUGEINT)) AS DECIMAL(28,0))
   * CAST(0.0001 AS DECIMAL(5,4)) AS DECIMAL(38,4)) AS gap_pct
FROM (SELECT date_trunc('month', block_date)::DATE AS block_month,
  CAST(round(sum(fees_usd), 6) AS DECIMAL(38,6)) AS own_fees_usd FROM fee_rows GROUP BY 1) o
FULL JOIN (SELECT date_trunc('month', block_date)::DATE AS block_month,
  CAST(round(sum(list_usd) * CAST(0.0035 AS DECIMAL(5,4)), 6) AS DECIMAL(38,6))
    AS published_fees_usd FROM trades GROUP BY 1) e ON o.block_month = e.block_month""")
def external_metric_gap(spark, d):
    month = F.trunc("block_date", "month").alias("block_month")
    own = model_rows(spark, d).groupBy(month).agg(six_dp(F.sum("fees_usd")).alias("own_fees_usd"))
    with exact_decimals(spark):
        external = td.trades(spark, d).groupBy(month).agg(
            six_dp(F.sum("list_usd") * F.lit("0.0035").cast("decimal(5,4)")).alias(
                "published_fees_usd"
            )
        )
    return audit.external_metric_gap(
        own, external, ["block_month"], "own_fees_usd", "published_fees_usd"
    )


@query("accrual_vs_realised", """
SELECT coalesce(a.pool, w.pool) AS pool,
  CAST(round(coalesce(a.v, 0), 6) AS DECIMAL(38,6)) AS accrued_usd,
  CAST(coalesce(w.v, 0) AS DECIMAL(38,6)) AS realised_usd,
  CAST(round(coalesce(a.v, CAST(0 AS DECIMAL(38,18)))
    - coalesce(w.v, CAST(0 AS DECIMAL(38,18))), 6) AS DECIMAL(38,6)) AS gap_usd,
  coalesce(w.n, 0) AS withdrawals, coalesce(w.u, 0) AS unpriced_withdrawals
FROM (SELECT pool, sum(revenue_usd) AS v FROM fee_rows GROUP BY pool) a
FULL JOIN (SELECT o_custkey % (SELECT count(*) + 1 FROM supplier) AS pool, count(*) AS n,
  count_if(o_orderkey % 13 = 0) AS u, sum(CASE WHEN o_orderkey % 13 <> 0 THEN
   CAST(CAST(o_totalprice AS DECIMAL(18,2)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(38,18)) END) AS v
  FROM orders GROUP BY 1) w ON a.pool = w.pool""")
def accrual_vs_realised(spark, d):
    entity = F.col("o_custkey") % td.table(spark, d, "supplier").agg(F.count("*") + 1).scalar()
    price = usd(F.col("o_totalprice").cast("decimal(18,2)") * F.lit("0.01").cast("decimal(3,2)"))
    withdrawals = td.table(spark, d, "orders").select(
        entity.alias("pool"), F.when(F.col("o_orderkey") % 13 != 0, price).alias("amount")
    )
    return audit.accrual_vs_realised(
        model_rows(spark, d), withdrawals, "pool", "revenue_usd", "amount"
    )


CALLS_SQL = {
    "evs": """
SELECT l_orderkey AS tx_hash, l_suppkey AS pool, CAST(l_quantity AS DECIMAL(18,2)) AS amount0,
  CAST(l_extendedprice AS DECIMAL(18,2)) AS amount1 FROM lineitem""",
    "calls": """
SELECT l_orderkey AS tx_hash, l_suppkey AS pool,
  CAST(CAST(l_quantity AS DECIMAL(18,2)) + (CASE WHEN l_partkey % 59 = 0 THEN 1 ELSE 0 END)
    AS DECIMAL(18,2)) AS amount0, CAST(l_extendedprice AS DECIMAL(18,2)) AS amount1
FROM lineitem, unnest(CASE WHEN l_partkey % 61 = 0 THEN [0, 1] ELSE [0] END)
WHERE l_partkey % 53 <> 0""",
    "e": """SELECT *, row_number() OVER (PARTITION BY tx_hash, pool, amount0, amount1) AS o FROM evs""",
    "c": """SELECT *, row_number() OVER (PARTITION BY tx_hash, pool, amount0, amount1) AS o
FROM calls""",
    "m": """
SELECT coalesce(e.tx_hash, c.tx_hash) AS tx_hash, coalesce(e.pool, c.pool) AS pool,
  count_if(e.tx_hash IS NOT NULL AND c.tx_hash IS NOT NULL) AS x,
  count_if(c.tx_hash IS NULL) AS eo, count_if(e.tx_hash IS NULL) AS co
FROM e FULL JOIN c ON e.tx_hash = c.tx_hash AND e.pool = c.pool AND e.amount0 = c.amount0
  AND e.amount1 = c.amount1 AND e.o = c.o GROUP BY 1, 2""",
}


@query("event_call_match", """
SELECT CAST(sum(x + eo) AS BIGINT) AS event_rows, CAST(sum(x + co) AS BIGINT) AS call_rows,
  CAST(sum(x) AS BIGINT) AS exact_matches, CAST(sum(least(eo, co)) AS BIGINT) AS amount_mismatches,
  CAST(sum(eo - least(eo, co)) AS BIGINT) AS events_without_call,
  CAST(sum(co - least(eo, co)) AS BIGINT) AS calls_without_event FROM m""", CALLS_SQL)
def event_call_match(spark, d):
    line, part = td.table(spark, d, "lineitem"), F.col("l_partkey")
    amount0 = F.col("l_quantity").cast("decimal(18,2)")
    amount1 = F.col("l_extendedprice").cast("decimal(18,2)").alias("amount1")
    ids = [F.col("l_orderkey").alias("tx_hash"), F.col("l_suppkey").alias("pool")]
    events = line.select(*ids, amount0.alias("amount0"), amount1)
    copies = F.when(part % 61 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    moved = (amount0 + F.when(part % 59 == 0, 1).otherwise(0)).cast("decimal(18,2)")
    calls = line.where(part % 53 != 0).withColumn("copy", F.explode(copies)).select(
        *ids, moved.alias("amount0"), amount1
    )
    return reconcile.event_call_match(events, calls, ["tx_hash", "pool"], ["amount0", "amount1"])


# ---- incremental maintenance ----------------------------------------------------------------


@query("refresh_bounds", """
SELECT * FROM (SELECT 'full' AS mode, DATE '1995-01-01' AS start_date, DATE '2030-01-01' AS end_date
UNION ALL SELECT 'incremental', max(block_date) - 2, DATE '2030-01-01' FROM trades
UNION ALL SELECT 'incremental_empty_target', DATE '1995-01-01', DATE '2030-01-01'
UNION ALL SELECT 'backfill', min(block_date) + 10, min(block_date) + 20 FROM trades)""")
def refresh_bounds(spark, d):
    low, high = td.trades_all(spark, d).agg(F.min("block_date"), F.max("block_date")).first()
    window = (date.fromordinal(low.toordinal() + 10), date.fromordinal(low.toordinal() + 20))
    runs = {
        "full": refresh.refresh_bounds(START, TODAY, incremental=False),
        "incremental": refresh.refresh_bounds(START, TODAY, newest=high),
        "incremental_empty_target": refresh.refresh_bounds(START, TODAY),
        "backfill": refresh.refresh_bounds(START, TODAY, newest=high, backfill=window),
    }
    rows = [(name, b.start, b.end) for name, b in runs.items()]
    return spark.createDataFrame(rows, "mode string, start_date date, end_date date")


def stored_model(spark: SparkSession, build: refresh.Build) -> str:
    """A full refresh into a fresh folder."""
    path = fresh_path(spark, "model")
    bounds = refresh.refresh_bounds(START, TODAY, incremental=False)
    refresh.full_refresh(path, build, bounds)
    return path


PER_DATE_SQL = "SELECT block_date, {} FROM {} GROUP BY block_date"


@query("replace_partitions", """
SELECT block_date, count(*) AS trade_rows, CAST(round(sum(fees_usd), 6) AS DECIMAL(38,6)) AS fees_usd
FROM (SELECT block_date, fees_usd FROM fee_rows WHERE block_date < (SELECT day FROM overlap_start)
 UNION ALL SELECT block_date, fees_usd + 1 FROM fee_rows
  WHERE block_date >= (SELECT day FROM overlap_start)) GROUP BY block_date""", OVERLAP_SQL)
def replace_partitions(spark, d):
    build, bounds = build_of(spark, d), overlap_bounds(spark, d)
    path = stored_model(spark, build)
    batch = build(bounds).withColumn("fees_usd", usd(F.col("fees_usd") + 1))
    tables.replace_partitions(batch, path)
    return tables.read_table(spark, path).groupBy("block_date").agg(
        F.count("*").alias("trade_rows"), six_dp(F.sum("fees_usd")).alias("fees_usd")
    )


@query("full_refresh", f"SELECT {ROLLUP_SQL} FROM fee_rows")
def full_refresh(spark, d):
    return fm.metric_rollup(tables.read_table(spark, stored_model(spark, build_of(spark, d))))


@query("backfill", """
SELECT block_date, count(*) AS trade_rows, CAST(round(sum(fees_usd), 6) AS DECIMAL(38,6)) AS fees_usd
FROM fee_rows WHERE NOT (block_date >= (SELECT min(block_date) + 10 FROM trades)
  AND block_date < (SELECT min(block_date) + 20 FROM trades) AND version = 'O')
GROUP BY block_date""")
def backfill(spark, d):
    """Recompute ten old dates from a corrected source and drop the dates it left empty."""
    rebuilt = build_of(spark, d)
    path = stored_model(spark, rebuilt)
    low = td.trades_all(spark, d).agg(F.min("block_date")).first()[0]
    window = (date.fromordinal(low.toordinal() + 10), date.fromordinal(low.toordinal() + 20))

    def corrected(bounds):
        return rebuilt(bounds).where(F.col("version") != "O")

    refresh.backfill(spark, path, corrected, START, TODAY, window, drop_empty=True)
    return tables.read_table(spark, path).groupBy("block_date").agg(
        F.count("*").alias("trade_rows"), six_dp(F.sum("fees_usd")).alias("fees_usd")
    )


HEALTH_SQL = """
SELECT block_date, count(*) AS trade_rows, count_if(is_repaired) AS repaired_rows,
  count_if(fee_base_usd IS NULL) AS unpriced_fee_base_rows,
  CAST(round(sum(fees_usd) - sum(supply_side_fees_usd) - sum(revenue_usd), 6) AS DECIMAL(38,6))
    AS accounting_residual_usd,
  count(DISTINCT (tx_hash, evt_index)) AS distinct_keys,
  count(*) - count(DISTINCT (tx_hash, evt_index)) AS duplicate_surplus_rows
FROM fee_rows GROUP BY block_date"""


@query("refresh_health", HEALTH_SQL)
def refresh_health(spark, d):
    return refresh.refresh_health(model_rows(spark, d))


SIMULATED_SQL = {
    "early": "SELECT * FROM fee_rows WHERE block_date < (SELECT day FROM overlap_start)",
    "replaced": """
SELECT * FROM early UNION ALL
SELECT * FROM fee_rows WHERE block_date >= (SELECT day FROM overlap_start)""",
}


@query("simulate_replacement", f"""
SELECT r.*, k.* FROM (SELECT {ROLLUP_SQL} FROM replaced) r, (
  SELECT count_if(b.tx_hash IS NULL) AS full_only_keys,
    count_if(a.tx_hash IS NULL) AS simulated_only_keys,
    count_if(a.tx_hash IS NOT NULL AND b.tx_hash IS NOT NULL AND a IS DISTINCT FROM b)
      AS field_mismatch_keys
  FROM fee_rows a FULL JOIN replaced b ON a.tx_hash = b.tx_hash AND a.evt_index = b.evt_index) k""",
    OVERLAP_SQL | SIMULATED_SQL)
def simulate_replacement(spark, d):
    bounds = overlap_bounds(spark, d)
    build = build_of(spark, d)
    full = build(refresh.refresh_bounds(START, TODAY, incremental=False))
    full = tables.frozen_relation(full, "full")
    simulated = refresh.simulate_replacement(full, build(bounds), bounds)
    simulated = tables.frozen_relation(simulated, "simulated")
    compared = digests.ranged_field_mismatch(
        full, simulated, "block_date", KEY, parity.FIELDS
    ).select(
        F.col("left_only_keys").alias("full_only_keys"),
        F.col("right_only_keys").alias("simulated_only_keys"),
        "field_mismatch_keys",
    )
    return reconcile.beside(fm.metric_rollup(simulated), compared)


@query("incremental_fee_model", TRADE_SQL)
def incremental_fee_model(spark, d):
    """Stored history up to the last four dates, then an incremental run that catches up."""
    path, build = fresh_path(spark, "incremental"), build_of(spark, d)
    newest = td.trades_all(spark, d).agg(F.max("block_date")).first()[0]
    yesterday = date.fromordinal(newest.toordinal() - 3)
    refresh.full_refresh(path, build, refresh.refresh_bounds(START, yesterday, incremental=False))
    refresh.incremental_refresh(spark, path, build, START, TODAY)
    return published(tables.read_table(spark, path))



LATE_SETTINGS = 2200
DRIFT_SQL = {
    "late": """
SELECT block_date AS day FROM trades WHERE part_key % 67 = 0 AND amount_usd IS NOT NULL
  AND block_date BETWEEN DATE '1997-03-01' AND DATE '1997-03-31'
UNION ALL SELECT bucket FROM prices WHERE bucket BETWEEN DATE '1996-06-01' AND DATE '1996-06-10'
UNION ALL SELECT t.block_date FROM trades t SEMI JOIN (
  SELECT pool FROM settings WHERE pool = 3 AND block_number >= 2200) s ON s.pool = t.pool""",
}


@query("drift_refresh", """
SELECT block_date, count(*) AS trade_rows, CAST(round(sum(fees_usd), 6) AS DECIMAL(38,6)) AS fees_usd,
  block_date IN (SELECT day FROM late) AS refreshed FROM fee_rows GROUP BY block_date""", DRIFT_SQL)
def drift_refresh(spark, d):
    """Late amounts, prices and settings: only the dates they reach are recomputed."""
    t, pools = stored_trades(spark, d), td.pools(spark, d)
    settings, prices = td.settings(spark, d), tables.frozen_relation(td.token_prices(t), "prices")
    day, bucket = F.col("block_date"), F.to_date("bucket")
    late = (F.col("part_key") % 67 == 0) & day.between(date(1997, 3, 1), date(1997, 3, 31))
    old_t = t.withColumn("amount_usd", F.when(~late, F.col("amount_usd")))
    old_s = settings.where((F.col("pool") != 3) | (F.col("block_number") < LATE_SETTINGS))
    old_p = prices.where(~bucket.between(date(1996, 6, 1), date(1996, 6, 10)))
    whole, path = refresh.refresh_bounds(START, TODAY, incremental=False), fresh_path(spark, "drift")
    before = tables.frozen_relation(refresh.input_digests(old_t, old_s, old_p), "inputs")
    build = refresh.incremental_build(old_t, pools, old_s, old_p, in_scope(), seg(), "day")
    refresh.full_refresh(path, build, whole)

    after = refresh.input_digests(t, settings, prices)
    dates = refresh.changed_dates(before, after, t)
    build = refresh.incremental_build(t, pools, settings, prices, in_scope(), seg(), "day")
    done = refresh.drift_refresh(spark, path, build, dates, whole)
    return tables.read_table(spark, path).groupBy("block_date").agg(
        F.count("*").alias("trade_rows"), six_dp(F.sum("fees_usd")).alias("fees_usd")
    ).withColumn("refreshed", day.isin(done))
