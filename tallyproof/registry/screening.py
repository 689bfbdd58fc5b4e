"""Registered queries of transfer netting and activity screening, with DuckDB twins."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyproof.functions import formulas as fx
from tallyproof.functions.decimals import RAW, exact_decimals
from tallyproof.operators import enrich, manifest, matching, reconcile, signals
from tallyproof.operators import transfers as tr
from tallyproof.plans import screening as sc
from tallyproof.registry.views import with_views
from tallyproof.sources import testdata as td
from tallyproof.sources.tables import frozen_relation

QUERIES = {}
ORACLES = {}
GATES = {"any": 0, "quarter": 2500, "half": 5000}
# The test events hold small source clusters only.
MIN_CLUSTER = 2
CHUNK = 40

BASE = {
    "raw_transfers": """
SELECT CASE WHEN event_type IN ('view', 'click') THEN 'A'
   WHEN event_type IN ('purchase', 'signup') THEN 'B' END AS token, user_id AS sender,
  CASE user_id % 5 WHEN 0 THEN user_id + 1 WHEN 1 THEN user_id - 1
   ELSE t0 - t0 % 5 + 2 + t0 % 3 END AS receiver,
  CASE WHEN user_id % 5 < 2 THEN 5000000
   ELSE CAST(CAST(value AS DECIMAL(18,2)) * 1000000 AS BIGINT) END AS value,
  CASE WHEN user_id % 5 < 2 THEN 1000000000 + (user_id // 5) * 1000
    + date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) ELSE event_id // 3 END AS tx_hash,
  event_id AS evt_index, ts AS event_time
FROM (SELECT *, (user_id * 31 + event_id * 7) % (SELECT max(user_id) + 1 FROM events) AS t0
  FROM events)""",
    "eligible": """
SELECT * FROM raw_transfers WHERE token IS NOT NULL AND value > 0 AND sender <> -1
  AND receiver <> -1 AND sender <> receiver""",
    "transfers": """
SELECT e.*, b.block_time, CAST(b.block_time AS DATE) AS block_date,
  CAST(epoch(b.block_time) AS BIGINT) // 3600 AS block_number, e.tx_hash % 100 AS tx_index
FROM eligible e JOIN (SELECT tx_hash, CAST(CASE WHEN tx_hash % 2 = 0
   THEN date_trunc('day', min(event_time)) ELSE date_trunc('hour', min(event_time)) END
   AS TIMESTAMP) AS block_time
  FROM eligible GROUP BY tx_hash) b ON e.tx_hash = b.tx_hash""",
    "curated": """
SELECT token, sender, receiver, tx_hash, evt_index,
  CASE WHEN evt_index % 223 = 0 THEN value + 1 ELSE value END AS value
FROM transfers, unnest(CASE WHEN evt_index % 227 = 0 THEN [0, 1] ELSE [0] END)
WHERE evt_index % 211 <> 0""",
    "txs": """
SELECT tx_hash, min(block_time) AS block_time,
  CASE WHEN min(sender) % 4 = 0 THEN min(sender) + 1 ELSE min(sender) END AS tx_sender,
  (21000 + (tx_hash % 1000) * 50) * 10 AS gas_used, 1000000000 * (1 + tx_hash % 50) AS gas_price
FROM transfers GROUP BY tx_hash""",
    "fees": """
SELECT * EXCLUDE (p8), CAST(p8 AS DECIMAL(28,0)) * CAST(0.00000001 AS DECIMAL(8,8)) AS price, p8,
  CAST((CAST(fee_wei AS HUGEINT) * p8 * 2 + 100000000) // 200000000 AS DECIMAL(38,0))
    * CAST(0.000000000000000001 AS DECIMAL(18,18)) AS fee_usd
FROM (SELECT *, gas_used * gas_price AS fee_wei,
  CAST(150045671234 + hour(block_time) * 1000000000 AS HUGEINT) AS p8 FROM txs)""",
    "edges": """
SELECT token, least(sender, receiver) AS low, greatest(sender, receiver) AS high,
  count_if(sender < receiver) AS forward_events, count_if(sender > receiver) AS reverse_events
FROM tr_main GROUP BY ALL HAVING forward_events > 0 AND reverse_events > 0""",
    "listed": "SELECT DISTINCT user_id AS address FROM events WHERE user_id % 9 = 0",
}


def window_views(s: str, start: str, end: str) -> dict[str, str]:
    """The lightweight pipeline of one window."""
    return {
        f"tr_{s}": f"""
SELECT * FROM transfers WHERE block_time >= TIMESTAMP '{start}' AND block_time < TIMESTAMP '{end}'""",
        f"legs_{s}": f"""
SELECT token, tx_hash, receiver AS address, sender AS counterparty, value AS incoming, 0 AS outgoing,
  block_time, block_date, block_number, tx_index FROM tr_{s}
UNION ALL SELECT token, tx_hash, sender, receiver, 0, value, block_time, block_date, block_number,
  tx_index FROM tr_{s}""",
        f"net_{s}": f"""
SELECT token, tx_hash, address, sum(incoming) AS incoming_raw, sum(outgoing) AS outgoing_raw,
  sum(incoming) - sum(outgoing) AS net_raw, min(block_time) AS block_time,
  min(block_date) AS block_date, min(block_number) AS block_number, min(tx_index) AS tx_index
FROM legs_{s} GROUP BY ALL""",
        f"moves_{s}": f"""
SELECT token, tx_hash, sum(abs(net_raw)) // 2 AS movement_raw, sum(incoming_raw) AS gross_raw,
  sum(outgoing_raw) AS outgoing_raw, sum(net_raw) AS net_residual_raw
FROM net_{s} GROUP BY ALL""",
        f"txm_{s}": f"SELECT tx_hash, sum(movement_raw) AS movement_raw FROM moves_{s} GROUP BY 1",
        f"sig_{s}": f"""
SELECT t.tx_hash, t.movement_raw, f.fee_wei, f.fee_usd,
  CASE WHEN movement_raw > 0 THEN CAST((CAST(fee_wei AS HUGEINT) * p8 * 10000)
    // (CAST(movement_raw AS HUGEINT) * 100000000000000000000::HUGEINT) AS BIGINT) END
    AS fee_to_movement_bps,
  CAST(fee_wei AS HUGEINT) * p8 >= CAST(movement_raw AS HUGEINT) * 100000000000000000000::HUGEINT
    AS fired
FROM txm_{s} t JOIN fees f ON t.tx_hash = f.tx_hash""",
        f"groups_{s}": f"SELECT * FROM net_{s} WHERE net_raw <> 0",
        f"pairs_{s}": f"""
SELECT address, token, count(*) AS group_count, count(DISTINCT block_date) AS active_days
FROM groups_{s} GROUP BY ALL HAVING group_count >= 10 AND active_days >= 4""",
        f"own_{s}": f"SELECT g.* FROM groups_{s} g SEMI JOIN pairs_{s} USING (address, token)",
        f"gaps_{s}": f"""
SELECT address, token, gap FROM (SELECT address, token, CAST(epoch(block_time) AS BIGINT)
  - lag(CAST(epoch(block_time) AS BIGINT)) OVER (PARTITION BY address, token
    ORDER BY block_number, tx_index, tx_hash) AS gap FROM own_{s}) WHERE gap IS NOT NULL""",
        f"ivals_{s}": f"""
SELECT address, token, n AS gap_count, CAST(4 * p[2] AS BIGINT) AS median_quarter_seconds,
  CASE WHEN s > 0 THEN CAST(floor(sqrt(CAST(n * q - s * s AS DOUBLE) / CAST(s * s AS DOUBLE))
    * 10000) AS BIGINT) END AS cv_bps,
  CASE WHEN p[2] <> 0 THEN CAST((CAST(4 * p[3] AS BIGINT) - CAST(4 * p[1] AS BIGINT)) * 10000
    // CAST(4 * p[2] AS BIGINT) AS BIGINT) END AS iqr_median_bps,
  CAST(z * 10000 // n AS BIGINT) AS zero_gap_share_bps
FROM (SELECT address, token, count(*) AS n, sum(gap) AS s, sum(gap * gap) AS q,
  count_if(gap = 0) AS z, quantile_cont(gap, [0.25, 0.5, 0.75]) AS p
 FROM gaps_{s} GROUP BY ALL)""",
        f"conc_{s}": f"""
SELECT address, token, CAST(max(c) * 10000 // sum(c) AS BIGINT) AS max_day_share_bps,
  CAST(sum(c * c) * 10000 // (sum(c) * sum(c)) AS BIGINT) AS hhi_bps
FROM (SELECT address, token, block_date, count(*) AS c FROM own_{s} GROUP BY ALL) GROUP BY ALL""",
        f"tpairs_{s}": f"""
SELECT c.address, c.token, coalesce(median_quarter_seconds > 0 AND cv_bps <= 7000
   AND iqr_median_bps <= 6000, false) AS clock_like,
  coalesce(zero_gap_share_bps >= 2000, false) AS same_second_burst,
  max_day_share_bps >= 8000 AND hhi_bps >= 6500 AS single_day_burst,
  coalesce(zero_gap_share_bps, 0) AS zero_gap_share_bps
FROM conc_{s} c LEFT JOIN ivals_{s} i ON c.address = i.address AND c.token = i.token""",
        f"tfam_{s}": f"""
SELECT address, bool_or(clock_like) AS clock_like, bool_or(same_second_burst) AS same_second_burst,
  bool_or(single_day_burst) AS single_day_burst,
  bool_or(clock_like OR same_second_burst OR single_day_burst) AS temporal,
  max(zero_gap_share_bps) AS zero_gap_share_bps FROM tpairs_{s} GROUP BY address""",
        f"cps_{s}": f"""
SELECT address, token, count(*) AS counterparties, CAST(sum(n) AS BIGINT) AS participations,
  CAST(max(n) * 10000 // sum(n) AS BIGINT) AS top_share_bps
FROM (SELECT address, token, counterparty, count(DISTINCT tx_hash) AS n FROM legs_{s} GROUP BY ALL)
GROUP BY ALL""",
        f"rfam_{s}": f"""
SELECT address, bool_or(counterparties <= 2 AND top_share_bps >= 9500) AS richness
FROM cps_{s} SEMI JOIN pairs_{s} USING (address, token) GROUP BY address""",
        f"econ_{s}": f"""
SELECT address, count(*) AS nonzero_groups, count_if(fired) AS fired_groups,
  count_if(fired) > 0 AND count_if(fired) * 10000 >= count(*) * 5000 AS economic,
  CAST(count_if(fired) * 10000 // count(*) AS BIGINT) AS economic_share_bps
FROM own_{s} o JOIN sig_{s} x ON o.tx_hash = x.tx_hash GROUP BY address""",
        f"actors_{s}": f"""
SELECT address, count(*) AS qualified_pairs, CAST(sum(group_count) AS BIGINT) AS group_count
FROM pairs_{s} GROUP BY address""",
        f"light_{s}": f"""
SELECT *, CAST(temporal AS INTEGER) + CAST(richness AS INTEGER) + CAST(economic AS INTEGER)
  AS families FROM actors_{s} JOIN tfam_{s} USING (address) JOIN rfam_{s} USING (address)
  JOIN econ_{s} USING (address)""",
    }


FUNDING = {
    "first": """
SELECT address, token, block_number AS first_block_number, tx_index AS first_tx_index,
  tx_hash AS first_tx_hash, block_time AS first_time FROM groups_main
SEMI JOIN actors_main USING (address)
QUALIFY row_number() OVER (PARTITION BY address ORDER BY block_number, tx_index, tx_hash, token) = 1""",
    "txnet": """
SELECT address, tx_hash, sum(i) - sum(o) AS net_raw, min(src) AS source_low, max(src) AS source_high,
  min(block_time) AS block_time, min(block_number) AS block_number, min(tx_index) AS tx_index
FROM (SELECT receiver AS address, tx_hash, value AS i, 0 AS o, sender AS src, block_time,
   block_number, tx_index FROM transfers WHERE block_time >= TIMESTAMP '2023-12-17'
   AND block_time < TIMESTAMP '2024-01-31'
  UNION ALL SELECT sender, tx_hash, 0, value, NULL, block_time, block_number, tx_index
   FROM transfers WHERE block_time >= TIMESTAMP '2023-12-17'
   AND block_time < TIMESTAMP '2024-01-31') GROUP BY ALL""",
    "looked_back": """
SELECT n.* FROM txnet n JOIN first f ON n.address = f.address
WHERE (block_number, tx_index, tx_hash) < (first_block_number, first_tx_index, first_tx_hash)
  AND block_time >= first_time - INTERVAL 30 DAY""",
    "funded": """
SELECT * FROM looked_back WHERE net_raw > 0
QUALIFY row_number() OVER (PARTITION BY address ORDER BY block_number, tx_index, tx_hash) = 1""",
    "status": """
SELECT f.address, f.tx_hash, f.net_raw AS funding_raw, date_trunc('hour', f.block_time)
   AS funding_hour, CASE WHEN source_low = source_high THEN source_low END AS source,
  source_low = source_high AS single_source, tx_sender <> f.address AS external_initiation,
  source_low = source_high AND tx_sender <> f.address AS is_proxy,
  CASE WHEN source_low = source_high THEN source_low END IN (SELECT address FROM listed)
   AND source_low = source_high AS is_listed
FROM funded f JOIN txs t ON t.tx_hash = f.tx_hash""",
    "proxies": "SELECT * FROM status WHERE is_proxy AND NOT is_listed",
    "clusters": """
SELECT a.source, cluster_size, CAST(ta * 10000 // cluster_size AS BIGINT) AS amount_share_bps,
  CAST(th * 10000 // cluster_size AS BIGINT) AS hour_share_bps
FROM (SELECT source, CAST(sum(n) AS BIGINT) AS cluster_size, max(n) AS ta
  FROM (SELECT source, funding_raw, count(*) AS n FROM proxies GROUP BY ALL) GROUP BY source) a
JOIN (SELECT source, max(n) AS th FROM (SELECT source, funding_hour, count(*) AS n FROM proxies
  GROUP BY ALL) GROUP BY source) h ON a.source = h.source""",
    "cflags": f"""
SELECT *, cluster_size >= {MIN_CLUSTER} AND (amount_share_bps >= 8000 OR hour_share_bps >= 5000)
   AS is_candidate, cluster_size >= {MIN_CLUSTER} AND amount_share_bps >= 8000
   AND hour_share_bps >= 5000 AS is_strong FROM clusters""",
    "ffam": """
SELECT p.address, true AS funding, c.is_strong AS strong_funding
FROM proxies p JOIN cflags c ON p.source = c.source WHERE c.is_candidate""",
    "fused": """
SELECT *, CASE WHEN families = 0 THEN 'organic candidate' WHEN families = 1 THEN 'ambiguous'
  ELSE 'likely inorganic' END AS actor_class
FROM (SELECT l.* EXCLUDE (families), coalesce(f.funding, false) AS funding, f.strong_funding,
  l.families + coalesce(CAST(f.funding AS INTEGER), 0) AS families
 FROM light_main l LEFT JOIN ffam f ON l.address = f.address)""",
    "cases": """
SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY near NULLS FIRST, e1 DESC NULLS LAST,
   e2 DESC NULLS LAST, e3 DESC NULLS LAST, e4 DESC NULLS LAST, address) AS case_number
FROM (SELECT *, CASE families WHEN 0 THEN 'organic_boundary' WHEN 1 THEN 'ambiguous_boundary'
   WHEN 2 THEN 'inorganic_boundary' ELSE 'high_cooccurrence' END AS stratum,
  CASE WHEN families < 3 THEN abs(economic_share_bps - 5000) END AS near,
  CASE WHEN families >= 3 THEN families END AS e1,
  CASE WHEN families >= 3 THEN economic_share_bps END AS e2,
  CASE WHEN families >= 3 THEN zero_gap_share_bps END AS e3,
  CASE WHEN families >= 3 THEN group_count END AS e4 FROM fused)
QUALIFY case_number <= 10""",
}

MATCHING = {
    "pe": """
SELECT t.token, least(sender, receiver) AS low, greatest(sender, receiver) AS high,
  sender < receiver AS fwd, CAST(epoch(block_time) AS BIGINT) AS at, value, t.block_number,
  t.tx_index, t.tx_hash, t.evt_index FROM tr_main t
JOIN edges e ON e.token = t.token AND e.low = least(sender, receiver)
  AND e.high = greatest(sender, receiver)""",
    "cells": """
SELECT w.name AS time_window, w.seconds, b.bps FROM (VALUES ('5 minutes', 300), ('1 hour', 3600),
  ('6 hours', 21600), ('24 hours', 86400), ('7 days', 604800)) w(name, seconds),
 (VALUES (0), (10), (100), (500)) b(bps)""",
    "picks": """
SELECT c.time_window, c.bps, c.seconds, a.evt_index AS me, o.evt_index AS other, a.fwd,
  abs(a.at - o.at) AS gap, abs(a.value - o.value) AS difference
FROM pe a JOIN pe o ON a.token = o.token AND a.low = o.low AND a.high = o.high AND a.fwd <> o.fwd
JOIN cells c ON abs(a.at - o.at) <= c.seconds
 AND abs(a.value - o.value) * 10000 <= c.bps * greatest(a.value, o.value)
QUALIFY row_number() OVER (PARTITION BY c.time_window, c.bps, a.evt_index ORDER BY abs(a.at - o.at),
  abs(a.value - o.value), o.block_number, o.tx_index, o.tx_hash, o.evt_index) = 1""",
    "mutual": """
SELECT a.time_window, a.bps, a.me AS forward_event, a.other AS reverse_event, a.gap, a.difference
FROM picks a JOIN picks b ON a.time_window = b.time_window AND a.bps = b.bps AND a.other = b.me
  AND b.other = a.me WHERE a.fwd""",
}

VIEWS = {
    **BASE,
    **window_views("main", "2024-01-16", "2024-01-31"),
    **window_views("adj", "2024-01-01", "2024-01-16"),
    **FUNDING,
    **MATCHING,
}


def query(name: str, oracle: str):
    def add(function):
        QUERIES[name] = function
        ORACLES[name] = with_views(oracle, VIEWS)
        return function
    return add


def segment() -> Column:
    """Days of block order; blocks of the test events are hours."""
    return F.floor(F.col("block_number") / 24)


def rules(window: tuple = td.MAIN) -> sc.Rules:
    return sc.Rules(*window, min_cluster=MIN_CLUSTER)


def inputs(spark: SparkSession, d: str, moved: DataFrame | None = None) -> sc.Inputs:
    moved = td.transfers(spark, d) if moved is None else moved
    return sc.Inputs(
        moved, td.transactions(moved), td.hour_prices(moved), td.exchange_list(spark, d), segment()
    )


def stored_inputs(spark: SparkSession, d: str) -> sc.Inputs:
    """Inputs whose transfers are a table, for screens, which read them many times."""
    return inputs(spark, d, frozen_relation(td.transfers(spark, d), "transfers"))


def stages(spark: SparkSession, d: str, window: tuple = td.MAIN, freeze: bool = False) -> sc.Stages:
    return sc.build_stages(inputs(spark, d), rules(window), freeze)


def screened(spark: SparkSession, d: str) -> DataFrame:
    return sc.activity_screen(stored_inputs(spark, d), rules())


# ---- transfers and movement -----------------------------------------------------------------


@query("base_transfer_filter", """
SELECT token, sender, receiver, value, evt_index FROM raw_transfers
WHERE token IN ('A', 'B') AND value > 0 AND sender <> 0 AND receiver <> 0 AND sender <> receiver""")
def base_transfer_filter(spark, d):
    keep = fx.base_transfer_filter(
        F.col("token"), F.col("sender"), F.col("receiver"), F.col("value"), td.TOKENS, 0
    )
    rows = td.raw_transfers(spark, d).where(keep)
    return rows.select("token", "sender", "receiver", F.col("value").cast("bigint").alias("value"),
                       "evt_index")


@query("raw_curated_reconcile", """
SELECT token, CAST(sum(l) AS BIGINT) AS raw_rows, CAST(sum(r) AS BIGINT) AS curated_rows,
  count_if(l > 0) AS raw_keys, count_if(r > 0) AS curated_keys,
  CAST(sum(lv) AS DECIMAL(38,0)) AS raw_amount, CAST(sum(rv) AS DECIMAL(38,0)) AS curated_amount,
  count_if(l > 0 AND r > 0) AS matched_keys, count_if(r = 0) AS raw_only_keys,
  count_if(l = 0) AS curated_only_keys,
  count_if(l > 0 AND r > 0 AND l <> r) AS row_count_mismatch_keys,
  count_if(l > 0 AND r > 0 AND lv <> rv) AS amount_mismatch_keys
FROM (SELECT token, tx_hash, evt_index, sum(l) AS l, sum(r) AS r, sum(lv) AS lv, sum(rv) AS rv
 FROM (SELECT token, tx_hash, evt_index, 1 AS l, 0 AS r, value AS lv, 0 AS rv FROM transfers
  UNION ALL SELECT token, tx_hash, evt_index, 0, 1, 0, value FROM curated) GROUP BY ALL)
GROUP BY token""")
def raw_curated_reconcile(spark, d):
    return reconcile.raw_curated_reconcile(
        td.transfers(spark, d), td.curated_transfers(spark, d), td.EVENT_KEY, "token", "value"
    )


@query("address_netting", """
SELECT token, tx_hash, address, CAST(incoming_raw AS DECIMAL(38,0)) AS incoming_raw,
  CAST(outgoing_raw AS DECIMAL(38,0)) AS outgoing_raw, CAST(net_raw AS DECIMAL(38,0)) AS net_raw
FROM net_main""")
def address_netting(spark, d):
    return stages(spark, d).netting.select(
        "token", "tx_hash", "address",
        *[F.col(c).cast(RAW).alias(c) for c in ("incoming_raw", "outgoing_raw", "net_raw")],
    )


MOVE_COLUMNS = ["movement_raw", "gross_raw", "outgoing_raw", "net_residual_raw"]


@query("tx_token_movement", "SELECT token, tx_hash, " + ", ".join(
    f"CAST({c} AS DECIMAL(38,0)) AS {c}" for c in MOVE_COLUMNS) + " FROM moves_main")
def tx_token_movement(spark, d):
    return tr.tx_token_movement(stages(spark, d).netting)


@query("movement_profile", """
SELECT token, count(*) AS token_groups, count_if(movement_raw > 0) AS positive_groups,
  count_if(movement_raw = 0) AS zero_groups, CAST(sum(movement_raw) AS DECIMAL(38,0)) AS movement_raw,
  CAST(sum(gross_raw) AS DECIMAL(38,0)) AS gross_raw,
  CAST(CAST((sum(movement_raw) * 2000000 + sum(gross_raw)) // (2 * sum(gross_raw)) AS DECIMAL(20,0))
    * CAST(0.0001 AS DECIMAL(5,4)) AS DECIMAL(38,4)) AS movement_of_gross_pct,
  count_if(net_residual_raw <> 0) AS nonzero_residual_groups,
  count_if(gross_raw <> outgoing_raw) AS unbalanced_groups,
  count_if(movement_raw > gross_raw) AS movement_above_gross_groups FROM moves_main GROUP BY token""")
def movement_profile(spark, d):
    return tr.movement_profile(tr.tx_token_movement(stages(spark, d).netting))


@query("exact_unit_convert", """
SELECT token, CAST(s AS DECIMAL(38,0)) AS value_raw,
  CAST(CAST(s AS DECIMAL(38,0)) * CAST(0.000001 AS DECIMAL(6,6)) AS DECIMAL(38,6)) AS value_units,
  (s // 1000000) * 1000000 + s % 1000000 = s AS recomposes
FROM (SELECT token, sum(value) AS s FROM transfers GROUP BY token)""")
def exact_unit_convert(spark, d):
    totals = tr.exact_unit_convert(td.transfers(spark, d), ["token"], "value", "value_raw")
    with exact_decimals(spark):
        return totals.select(
            "token", "value_raw",
            fx.from_units(F.col("value_raw"), 6).alias("value_units"),
            fx.recomposes(F.col("value_raw"), 6).alias("recomposes"),
        )


def tx_fee_rows(spark: SparkSession, d: str) -> DataFrame:
    moved = td.transfers(spark, d)
    return sc.tx_fees(td.transactions(moved), td.hour_prices(moved), "GAS")


@query("tx_fee", "SELECT tx_hash, CAST(fee_wei AS DECIMAL(38,0)) AS fee_wei, fee_usd FROM fees")
def tx_fee(spark, d):
    return tx_fee_rows(spark, d).select("tx_hash", "fee_wei", "fee_usd")


@query("hourly_price_join", """
SELECT tx_hash, gas_used, gas_price, CAST(price AS DECIMAL(20,8)) AS gas_asset_price FROM fees""")
def hourly_price_join(spark, d):
    moved = td.transfers(spark, d)
    rows = enrich.hourly_price_join(
        td.transactions(moved), td.hour_prices(moved), "block_time", "GAS", "gas_asset_price"
    )
    return rows.select("tx_hash", "gas_used", "gas_price", "gas_asset_price")


@query("fee_to_movement", """
SELECT tx_hash, CAST(movement_raw AS DECIMAL(38,0)) AS movement_raw, fee_to_movement_bps, fired
FROM sig_main""")
def fee_to_movement(spark, d):
    rows = stages(spark, d).signals
    return rows.select("tx_hash", "movement_raw", "fee_to_movement_bps", "fired")


@query("tx_movement_ledger", """
SELECT count(*) AS transactions, count_if(movement_raw > 0) AS positive_movement_transactions,
  count_if(movement_raw = 0) AS zero_movement_transactions, 0::BIGINT AS transactions_without_fee,
  CAST(sum(movement_raw) AS DECIMAL(38,0)) AS movement_raw,
  CAST(sum(fee_wei) AS DECIMAL(38,0)) AS fee_wei,
  CAST(round(sum(fee_usd), 6) AS DECIMAL(38,6)) AS fee_usd FROM sig_main""")
def tx_movement_ledger(spark, d):
    per_tx = tr.tx_movement(tr.tx_token_movement(stages(spark, d).netting))
    return tr.tx_movement_ledger(per_tx, tx_fee_rows(spark, d))


# ---- qualification and features -------------------------------------------------------------


@query("qualify_pairs", "SELECT address, token, group_count, active_days FROM pairs_main")
def qualify_pairs(spark, d):
    return stages(spark, d).pairs


@query("actor_rollup", """
SELECT p.address, count(*) AS qualified_pairs, CAST(sum(group_count) AS BIGINT) AS group_count,
  bool_or(clock_like) AS clock_like FROM pairs_main p JOIN tpairs_main t USING (address, token)
GROUP BY p.address""")
def actor_rollup(spark, d):
    s = stages(spark, d, freeze=True)
    flags = sc.temporal(s, segment()).select(*tr.PAIR, "clock_like")
    return tr.actor_rollup(s.pairs.join(flags, tr.PAIR), ["clock_like"])


@query("daily_concentration", "SELECT * FROM conc_main")
def daily_concentration(spark, d):
    return tr.daily_concentration(stages(spark, d).own_groups)


@query("counterparty_features", "SELECT * FROM cps_main")
def counterparty_features(spark, d):
    return tr.counterparty_features(stages(spark, d).window)


@query("interval_features", "SELECT * FROM ivals_main")
def interval_features(spark, d):
    return tr.interval_features(tr.group_gaps(stages(spark, d, freeze=True).own_groups, segment()))


@query("distribution_profile", """
SELECT token, k AS percentile, min(v) AS percentile_value, any_value(n) AS value_count,
  any_value(lo) AS min_value, any_value(hi) AS max_value
FROM (SELECT token, CAST(movement_raw AS BIGINT) AS v, row_number() OVER (PARTITION BY token
   ORDER BY movement_raw) AS r, count(*) OVER (PARTITION BY token) AS n,
  CAST(min(movement_raw) OVER (PARTITION BY token) AS BIGINT) AS lo,
  CAST(max(movement_raw) OVER (PARTITION BY token) AS BIGINT) AS hi FROM moves_main),
 (SELECT CAST(unnest(range(1, 100)) AS INTEGER) AS k)
WHERE r * 100 >= k * n GROUP BY token, k""")
def distribution_profile(spark, d):
    movement = frozen_relation(tr.tx_token_movement(stages(spark, d).netting), "movement")
    return signals.distribution_profile(movement, "movement_raw", ["token"])


@query("economic_actor_share", """
SELECT address, nonzero_groups, fired_groups, economic_share_bps FROM econ_main""")
def economic_actor_share(spark, d):
    rows = sc.economic(stages(spark, d, freeze=True), 5000)
    return rows.select("address", "nonzero_groups", "fired_groups", "economic_share_bps")


# ---- funding --------------------------------------------------------------------------------


@query("first_activity", """
SELECT address, token, first_block_number, first_tx_index, first_tx_hash FROM first""")
def first_activity(spark, d):
    s = stages(spark, d)
    rows = tr.first_activity(s.groups, tr.actor_rollup(s.pairs))
    return rows.drop("first_time")


def lookback(spark: SparkSession, d: str) -> DataFrame:
    return sc.actor_lookback(inputs(spark, d), rules(), stages(spark, d))


@query("lookback_range_join", """
SELECT address, tx_hash, CAST(net_raw AS DECIMAL(38,0)) AS net_raw, source_low, source_high
FROM looked_back""")
def lookback_range_join(spark, d):
    kept = ["address", "tx_hash", "net_raw", "source_low", "source_high"]
    return lookback(spark, d).select(*kept)


@query("first_funding_tx", """
SELECT address, tx_hash, CAST(net_raw AS DECIMAL(38,0)) AS net_raw FROM funded""")
def first_funding_tx(spark, d):
    return tr.first_funding_tx(lookback(spark, d)).select("address", "tx_hash", "net_raw")


def funding_status(spark: SparkSession, d: str, freeze: bool = False) -> DataFrame:
    return sc.funding(inputs(spark, d), rules(), stages(spark, d, freeze=freeze))


@query("funding_proxy", """
SELECT address, tx_hash, CAST(funding_raw AS DECIMAL(38,0)) AS funding_raw, source, single_source,
  external_initiation, is_proxy, coalesce(is_listed, false) AS is_listed FROM status""")
def funding_proxy(spark, d):
    return funding_status(spark, d).drop("funding_hour")


@query("annotation_exclude", """
SELECT token, evt_index, sender FROM tr_main WHERE sender NOT IN (SELECT address FROM listed)""")
def annotation_exclude(spark, d):
    rows = stages(spark, d).window.select("token", "evt_index", "sender")
    return enrich.annotation_exclude(rows, td.exchange_list(spark, d), "sender", "address")


@query("annotation_split", """
SELECT token, sender IN (SELECT address FROM listed) AS is_listed, count(*) AS row_count
FROM tr_main GROUP BY ALL""")
def annotation_split(spark, d):
    rows = enrich.annotation_split(
        stages(spark, d).window, td.exchange_list(spark, d), "sender", "address"
    )
    return rows.groupBy("token", "is_listed").agg(F.count("*").alias("row_count"))


def clusters(spark: SparkSession, d: str) -> DataFrame:
    return signals.source_clusters(sc.open_proxies(funding_status(spark, d)))


@query("source_clusters", "SELECT * FROM clusters")
def source_clusters(spark, d):
    return clusters(spark, d)


@query("cluster_flags", "SELECT source, is_candidate, is_strong FROM cflags")
def cluster_flags(spark, d):
    rows = signals.cluster_flags(clusters(spark, d), MIN_CLUSTER)
    return rows.select("source", "is_candidate", "is_strong")


@query("funding_status_ledger", """
SELECT count(*) AS actors, count(s.address) AS observed_inflow_actors,
  count(*) - count(s.address) AS censored_actors,
  count_if(single_source) AS single_source_actors,
  count_if(s.address IS NOT NULL AND NOT coalesce(single_source, false)) AS multi_source_actors,
  count_if(external_initiation) AS external_initiation_actors, count_if(is_proxy) AS proxy_actors,
  count_if(is_proxy AND is_listed) AS listed_source_actors,
  count_if(is_proxy AND NOT is_listed) AS unlisted_source_actors,
  count(DISTINCT CASE WHEN is_proxy AND NOT is_listed THEN source END) AS distinct_unlisted_sources
FROM actors_main a LEFT JOIN status s ON a.address = s.address""")
def funding_status_ledger(spark, d):
    built, given = stages(spark, d, freeze=True), inputs(spark, d)
    status = sc.funding(given, rules(), built)
    return signals.funding_status_ledger(tr.actor_rollup(built.pairs), status)


@query("funding_coverage_matrix", """
SELECT size_band, amount_band, hour_band, count(*) AS sources,
  CAST(sum(cluster_size) AS BIGINT) AS actors
FROM (SELECT cluster_size, CASE WHEN cluster_size >= 50 THEN 50 WHEN cluster_size >= 20 THEN 20
  WHEN cluster_size >= 10 THEN 10 WHEN cluster_size >= 5 THEN 5 ELSE 0 END AS size_band,
 CASE WHEN amount_share_bps >= 9500 THEN 9500 WHEN amount_share_bps >= 8000 THEN 8000
  WHEN amount_share_bps >= 5000 THEN 5000 ELSE 0 END AS amount_band,
 CASE WHEN hour_share_bps >= 9500 THEN 9500 WHEN hour_share_bps >= 8000 THEN 8000
  WHEN hour_share_bps >= 5000 THEN 5000 ELSE 0 END AS hour_band FROM clusters) GROUP BY ALL""")
def funding_coverage_matrix(spark, d):
    proxies = sc.open_proxies(funding_status(spark, d))
    return signals.funding_coverage_matrix(proxies, signals.source_clusters(proxies))


# ---- families, fusion and reports -----------------------------------------------------------


@query("temporal_family", "SELECT * FROM tfam_main")
def temporal_family(spark, d):
    return signals.temporal_family(sc.temporal(stages(spark, d, freeze=True), segment()))


@query("richness_family", "SELECT * FROM rfam_main")
def richness_family(spark, d):
    return signals.richness_family(sc.richness(stages(spark, d)))


@query("funding_family", "SELECT * FROM ffam")
def funding_family(spark, d):
    proxies = frozen_relation(sc.open_proxies(funding_status(spark, d)), "proxies")
    flags = signals.cluster_flags(signals.source_clusters(proxies), MIN_CLUSTER)
    return signals.funding_family(proxies, flags)


@query("economic_family", "SELECT address, economic FROM econ_main")
def economic_family(spark, d):
    return sc.economic(stages(spark, d, freeze=True), 5000).select("address", "economic")


FUSED_COLUMNS = ["address", *signals.FAMILIES, "families", "actor_class"]


@query("fuse_families", f"SELECT {', '.join(FUSED_COLUMNS)} FROM fused")
def fuse_families(spark, d):
    return screened(spark, d).select(*FUSED_COLUMNS)


@query("class_partition", """
SELECT actor_class, n AS actors, CAST(CAST((CAST(n AS HUGEINT) * 200000000 + t) // (2 * t)
   AS DECIMAL(20,0)) * CAST(0.000001 AS DECIMAL(6,6)) AS DECIMAL(38,6)) AS share_pct,
  ((SELECT count(DISTINCT address) FROM pairs_main) - t)::BIGINT AS partition_residual
FROM (SELECT actor_class, count(*) AS n, (SELECT count(*) FROM fused) AS t FROM fused GROUP BY 1)""")
def class_partition(spark, d):
    return signals.class_partition(screened(spark, d), stages(spark, d).pairs)


@query("strict_inclusive_bounds", """
SELECT count(*) AS actors, count_if(families = 0) AS strict_organic,
  count_if(families <= 1) AS inclusive_organic, count_if(families >= 2) AS strict_inorganic,
  count_if(families >= 1) AS inclusive_inorganic FROM fused""")
def strict_inclusive_bounds(spark, d):
    return signals.strict_inclusive_bounds(screened(spark, d))


@query("threshold_grid", """
SELECT gate, count(*) AS actors, count_if(hit) AS economic_actors,
  count_if(b + CAST(hit AS INTEGER) = 0) AS organic_candidates,
  count_if(b + CAST(hit AS INTEGER) = 1) AS ambiguous_actors,
  count_if(b + CAST(hit AS INTEGER) >= 2) AS likely_inorganic
FROM (SELECT gate, families - CAST(economic AS INTEGER) AS b,
  fired_groups > 0 AND fired_groups * 10000 >= nonzero_groups * bps AS hit
 FROM fused, (VALUES ('any', 0), ('quarter', 2500), ('half', 5000)) g(gate, bps)) GROUP BY gate""")
def threshold_grid(spark, d):
    return signals.threshold_grid(screened(spark, d), GATES)


@query("reverse_edges", """
SELECT *, forward_events + reverse_events AS pair_events,
  forward_events * reverse_events AS combinations FROM edges""")
def reverse_edges(spark, d):
    return tr.reverse_edges(stages(spark, d).window)


def matched(spark: SparkSession, d: str) -> DataFrame:
    rows = frozen_relation(stages(spark, d).window, "window")
    events = matching.pair_events(rows, tr.reverse_edges(rows))
    return matching.mutual_best_match(events, matching.TOLERANCES, timedelta(days=7))


@query("mutual_best_match", """
SELECT bps, forward_event, reverse_event, gap AS gap_seconds, difference AS raw_difference
FROM mutual WHERE time_window = '7 days'""")
def mutual_best_match(spark, d):
    return matched(spark, d).select(
        "bps", F.col("forward.evt_index").alias("forward_event"),
        F.col("reverse.evt_index").alias("reverse_event"), "gap_seconds", "raw_difference",
    )


@query("return_grid", """
SELECT c.time_window, c.bps AS tolerance_bps, count(m.bps) AS matched_pairs,
  2 * count(m.bps) AS matched_events, max(m.gap) AS largest_gap_seconds
FROM cells c LEFT JOIN mutual m ON c.time_window = m.time_window AND c.bps = m.bps
GROUP BY c.time_window, c.bps""")
def return_grid(spark, d):
    return matching.return_grid(matched(spark, d), matching.TOLERANCES, matching.WINDOWS)


def _share(n: str, t: str) -> str:
    return (f"CAST(CAST((CAST({n} AS HUGEINT) * 200000000 + {t}) // (2 * {t}) AS DECIMAL(20,0)) "
            "* CAST(0.000001 AS DECIMAL(6,6)) AS DECIMAL(38,6))")  # fmt: skip


@query("adjacent_windows", f"""
SELECT *, max(CASE WHEN window_name = 'main' THEN share_pct END) OVER ()
   - max(CASE WHEN window_name = 'adjacent' THEN share_pct END) OVER () AS share_difference_points,
  CASE WHEN base <> 0 THEN CAST(CAST(sign(lead_pct - base) AS INTEGER) * CAST((2
     * CAST(abs(lead_pct - base) * 1000000 AS HUGEINT) * 1000000 + CAST(base * 1000000 AS HUGEINT))
     // (2 * CAST(base * 1000000 AS HUGEINT)) AS DECIMAL(28,0)) * CAST(0.0001 AS DECIMAL(5,4))
    AS DECIMAL(38,4)) END AS relative_difference_pct
FROM (SELECT *, max(CASE WHEN window_name = 'main' THEN share_pct END) OVER () AS lead_pct,
  max(CASE WHEN window_name = 'adjacent' THEN share_pct END) OVER () AS base
 FROM (SELECT *, {_share("likely_inorganic", "actors")} AS share_pct
 FROM (SELECT window_name, count(*) AS actors, count_if(temporal) AS temporal_actors,
  count_if(richness) AS richness_actors, count_if(economic) AS economic_actors,
  count_if(families = 0) AS organic_candidates, count_if(families = 1) AS ambiguous_actors,
  count_if(families >= 2) AS likely_inorganic
 FROM (SELECT 'main' AS window_name, * FROM light_main
  UNION ALL SELECT 'adjacent', * FROM light_adj) GROUP BY window_name)))""".replace(
    "SELECT *, max(CASE WHEN window_name = 'main' THEN share_pct END) OVER ()\n   -",
    "SELECT * EXCLUDE (lead_pct, base), max(CASE WHEN window_name = 'main' THEN share_pct END)"
    " OVER ()\n   -"))
def adjacent_windows(spark, d):
    windows = {"main": rules(td.MAIN), "adjacent": rules(td.ADJACENT)}
    rows = sc.adjacent_windows(stored_inputs(spark, d), windows)
    return signals.window_comparison(rows, "window_name", "main", "adjacent")


CASE_COLUMNS = ["stratum", "case_number", "address", "families", "economic_share_bps",
                "group_count"]


@query("stratified_cases", f"SELECT {', '.join(CASE_COLUMNS)} FROM cases")
def stratified_cases(spark, d):
    return signals.stratified_cases(screened(spark, d)).select(*CASE_COLUMNS)


@query("late_annotation", """
SELECT stratum, count(*) AS cases, count_if(address % 6 = 0) AS labelled_cases,
  CAST(sum(CASE WHEN address % 12 = 0 THEN 2 WHEN address % 6 = 0 THEN 1 ELSE 0 END) AS BIGINT)
    AS label_rows, count_if(address % 9 = 0) AS listed_cases FROM cases GROUP BY stratum""")
def late_annotation(spark, d):
    cases = frozen_relation(signals.stratified_cases(screened(spark, d)), "cases")
    return enrich.late_annotation(
        cases, td.labels(spark, d), td.exchange_list(spark, d), "address", "stratum"
    )


def _recomputed(stored: str) -> str:
    """Stored evidence next to the views that derive it from raw rows."""
    fields = {"temporal": "coalesce(t.temporal, false)", "richness": "coalesce(r.richness, false)", "economic": "e.economic",
              "nonzero_groups": "e.nonzero_groups", "fired_groups": "e.fired_groups"}
    shown = ", ".join(f"c.{f} AS stored_{f}, {v} AS rebuilt_{f}" for f, v in fields.items())
    same = " AND ".join(f"c.{f} IS NOT DISTINCT FROM {v}" for f, v in fields.items())
    return f"""
SELECT c.address, c.stratum, {shown}, {same} AS case_passes FROM ({stored}) c
LEFT JOIN tfam_main t ON t.address = c.address LEFT JOIN rfam_main r ON r.address = c.address
LEFT JOIN econ_main e ON e.address = c.address"""


FAULTY_CASES_SQL = """
SELECT * REPLACE (CASE WHEN address % 3 = 0 THEN NOT temporal ELSE temporal END AS temporal,
  CASE WHEN address % 5 = 0 THEN fired_groups + 1 ELSE fired_groups END AS fired_groups)
FROM cases"""


def recomputed(spark: SparkSession, d: str, faulty: bool) -> DataFrame:
    fused = sc.activity_screen(inputs(spark, d), rules(), stages(spark, d, freeze=True))
    cases = frozen_relation(signals.stratified_cases(fused), "cases")
    if faulty:
        key = F.col("address")
        cases = cases.withColumn(
            "temporal", F.when(key % 3 == 0, ~F.col("temporal")).otherwise(F.col("temporal"))
        ).withColumn("fired_groups", F.col("fired_groups") + F.when(key % 5 == 0, 1).otherwise(0))
    return sc.case_recompute(cases, inputs(spark, d), rules())


@query("case_recompute", _recomputed("SELECT * FROM cases"))
def case_recompute(spark, d):
    return recomputed(spark, d, False)


@query("case_recompute_faulty", _recomputed(FAULTY_CASES_SQL))
def case_recompute_faulty(spark, d):
    """Changed stored flags and counts fail exactly their own cases."""
    return recomputed(spark, d, True)


def packed(spark: SparkSession, d: str) -> DataFrame:
    rows = frozen_relation(screened(spark, d).select("address", "temporal"), "actors")
    return manifest.manifest_pack(
        rows, "address", "temporal", CHUNK, F.floor(F.col("address") / 64)
    )


PACK_SQL = f"""
SELECT chunk, count(*) AS entries, CAST(sum(flag) AS BIGINT) AS flagged,
  string_agg(address || ':' || flag, '~' ORDER BY n) AS chunk_text
FROM (SELECT address, CAST(temporal AS INTEGER) AS flag, n, (n - 1) // {CHUNK} + 1 AS chunk
 FROM (SELECT address, temporal, row_number() OVER (ORDER BY address) AS n FROM tfam_main))
GROUP BY chunk"""
VIEWS["pack"] = PACK_SQL


@query("manifest_pack", """
SELECT *, length(chunk_text) AS characters, sha256(chunk_text) AS chunk_sha256 FROM pack""")
def manifest_pack(spark, d):
    return packed(spark, d)


UNPACK_SQL = """
SELECT * FROM (WITH entries AS (
  SELECT chunk, string_split(unnest(string_split(chunk_text, '~')), ':') AS parts FROM pack),
parsed AS (
  SELECT count(*) AS parsed_rows, count(DISTINCT parts[1]) AS distinct_keys,
    sum(parts[2]::INT) AS parsed_flagged,
    sum(length(parts[1]) + length(parts[2]) + 1) + count(*) - 1 AS rebuilt_characters FROM entries),
declared AS (
  SELECT count(*) AS n, count_if(temporal) AS flagged FROM tfam_main),
whole AS (
  SELECT string_agg(chunk_text, '~' ORDER BY chunk) AS text,
    sha256(string_agg(sha256(chunk_text), '~' ORDER BY chunk)) AS digest FROM pack),
again AS (
  SELECT sha256(string_agg(sha256(t), '~' ORDER BY chunk)) AS digest FROM (
    SELECT chunk, string_agg(parts[1] || ':' || parts[2], '~' ORDER BY parts[1]::BIGINT) AS t
    FROM entries GROUP BY chunk)),
direct AS (
  SELECT sha256(string_agg(address || ':' || temporal::INT, '~' ORDER BY address)) AS digest
  FROM tfam_main)
SELECT CAST(parsed_rows AS BIGINT) AS parsed_rows, CAST(distinct_keys AS BIGINT) AS distinct_keys,
  CAST(parsed_flagged AS BIGINT) AS parsed_flagged,
  CAST(rebuilt_characters AS BIGINT) AS rebuilt_characters, again.digest AS rebuilt_sha256,
  direct.digest AS text_sha256,
  parsed_rows = n AND distinct_keys = n AND parsed_flagged = flagged
    AND rebuilt_characters = length(text) AND again.digest = whole.digest
    AND direct.digest = sha256(text) AS manifest_matches
FROM parsed, declared, whole, again, direct)"""


@query("manifest_unpack_check", UNPACK_SQL)
def manifest_unpack_check(spark, d):
    chunks = frozen_relation(packed(spark, d), "manifest")
    return manifest.manifest_unpack_check(chunks, manifest.manifest_digest(chunks))


SCREEN_COLUMNS = [
    "address", "qualified_pairs", "group_count", *signals.FAMILIES, "clock_like",
    "same_second_burst", "single_day_burst", "zero_gap_share_bps", "nonzero_groups",
    "fired_groups", "economic_share_bps", "strong_funding", "families", "actor_class",
]


@query("activity_screen", f"SELECT {', '.join(SCREEN_COLUMNS)} FROM fused")
def activity_screen(spark, d):
    return screened(spark, d).select(*SCREEN_COLUMNS)
