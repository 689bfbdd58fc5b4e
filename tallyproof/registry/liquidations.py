"""Registered queries of the liquidation model and its reconciliation, with DuckDB twins."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyproof.operators import enrich
from tallyproof.plans import liquidations as lq
from tallyproof.registry.views import with_views
from tallyproof.sources import scans
from tallyproof.sources import testdata as td
from tallyproof.sources.tables import frozen_relation

QUERIES = {}
ORACLES = {}
KEY = td.EVENT_KEY
WINDOW = (td.FIRST_DAY, td.LAST_DAY)


def _asset(expr: str) -> str:
    return f"CASE WHEN ({expr}) % 29 = 28 THEN -1 ELSE ({expr}) % 29 END"


def _decimals(expr: str) -> str:
    return f"CASE {expr} % 3 WHEN 0 THEN 2 WHEN 1 THEN 6 ELSE 8 END"


def _leg(side: str, owner: str, payer: str) -> str:
    return f"""
SELECT 'chain_a' AS blockchain, 'lender' AS project, '3' AS version, block_time, block_number,
  project_contract_address, tx_hash, evt_index, {side}_asset AS token_address,
  borrower AS {owner}, liquidator AS {payer}, liquidator, -{side}_amount AS amount,
  {side}_amount_raw AS amount_raw, -{side}_amount_usd AS amount_usd, {side}_symbol AS symbol
FROM liq_priced"""


def _faulty(leg: str, payer: str) -> str:
    return f"""
SELECT * EXCLUDE (p) REPLACE (p AS project,
  CASE WHEN tx_hash % 89 = 0 THEN amount_raw + 1 ELSE amount_raw END AS amount_raw,
  CASE WHEN tx_hash % 83 = 0 THEN NULL WHEN tx_hash % 79 = 0 THEN amount_usd * 2
    ELSE amount_usd END AS amount_usd,
  CASE WHEN tx_hash % 103 = 0 THEN token_address + 1 ELSE token_address END AS token_address,
  CASE WHEN tx_hash % 107 = 0 THEN {payer} + 1 ELSE {payer} END AS {payer},
  CASE WHEN tx_hash % 109 = 0 THEN block_number + 1 ELSE block_number END AS block_number,
  CASE WHEN tx_hash % 113 = 0 THEN -amount ELSE amount END AS amount)
FROM (SELECT *, unnest(list_concat(['lender'],
   CASE WHEN tx_hash % 101 = 0 THEN ['lender'] ELSE [] END,
   CASE WHEN tx_hash % 61 = 0 THEN ['lender_fork'] ELSE [] END,
   CASE WHEN tx_hash % 122 = 0 THEN ['lender_lite'] ELSE [] END)) AS p
  FROM {leg} WHERE tx_hash % 97 <> 0)"""


def _reconciled(debt: str, collateral: str) -> str:
    return f"""
SELECT m.*, b.tx_hash IS NOT NULL AS left_found, b.block_number AS left_block_number,
  b.token_address AS left_token_address, b.borrower AS left_borrower, b.repayer AS left_repayer,
  b.liquidator AS left_liquidator, b.amount AS left_amount, b.amount_raw AS left_amount_raw,
  b.amount_usd AS left_amount_usd, s.tx_hash IS NOT NULL AS right_found,
  s.block_number AS right_block_number, s.token_address AS right_token_address,
  s.depositor AS right_depositor, s.withdrawn_to AS right_withdrawn_to,
  s.liquidator AS right_liquidator, s.amount AS right_amount, s.amount_raw AS right_amount_raw,
  s.amount_usd AS right_amount_usd
FROM liq_priced m
LEFT JOIN {debt} b ON m.tx_hash = b.tx_hash AND m.evt_index = b.evt_index
LEFT JOIN {collateral} s ON m.tx_hash = s.tx_hash AND m.evt_index = s.evt_index"""


def _checks(p: str, side: str, owner: str, payer: str) -> dict[str, str]:
    def off(a: str, b: str) -> str:
        return f"{p}_found AND {a} IS DISTINCT FROM {b}"

    return {
        f"{side}_block_number_mismatch_rows": off("block_number", f"{p}_block_number"),
        f"{side}_asset_mismatch_rows": off(f"{side}_asset", f"{p}_token_address"),
        f"{side}_borrower_mismatch_rows": off("borrower", f"{p}_{owner}"),
        f"{side}_liquidator_mapping_mismatch_rows": f"{p}_found AND "
        f"(liquidator IS DISTINCT FROM {p}_liquidator OR liquidator IS DISTINCT FROM {p}_{payer})",
        f"{side}_raw_amount_mismatch_rows": off(f"{side}_amount_raw", f"{p}_amount_raw"),
        f"{side}_token_amount_exact_mismatch_rows": off(f"{side}_amount", f"abs({p}_amount)"),
        f"{side}_nonnegative_signed_amount_rows": f"{p}_found AND {p}_amount >= 0",
        f"{side}_usd_null_status_mismatch_rows": f"{p}_found AND "
        f"({side}_amount_usd IS NULL) <> ({p}_amount_usd IS NULL)",
        f"{side}_usd_exact_mismatch_rows": off(f"{side}_amount_usd", f"abs({p}_amount_usd)"),
    }


CHECKS = {
    **_checks("left", "debt", "borrower", "repayer"),
    **_checks("right", "collateral", "depositor", "withdrawn_to"),
}


def _quality(source: str) -> str:
    return "SELECT " + ", ".join(f"count_if({c}) AS {n}" for n, c in CHECKS.items()) + (
        f" FROM {source}"
    )


def _top(source: str, p: str, side: str) -> str:
    n = f"max_{side}_diff"
    return f"""
SELECT max(d) AS {n}_abs_diff, max(CASE WHEN r = 1 THEN h END) AS {n}_tx_hash,
  max(CASE WHEN r = 1 THEN evt_index END) AS {n}_evt_index,
  max(CASE WHEN r = 1 THEN {side}_symbol END) AS {n}_symbol,
  max(CASE WHEN r = 1 THEN {side}_amount_usd END) AS {n}_model_usd,
  max(CASE WHEN r = 1 THEN o END) AS {n}_leg_usd_abs
FROM (SELECT *, row_number() OVER (ORDER BY d DESC, block_time, tx_hash, evt_index) AS r
 FROM (SELECT *, '0x' || printf('%X', tx_hash) AS h, abs({p}_amount_usd) AS o,
    abs({side}_amount_usd - abs({p}_amount_usd)) AS d FROM {source}
  WHERE {p}_found AND {side}_amount_usd <> abs({p}_amount_usd)))"""


def _profiles(debt: str, collateral: str) -> str:
    def keys(a: str) -> str:
        return f"count(DISTINCT ({a}.tx_hash, {a}.evt_index))"

    parts = [f"""(SELECT count(*) AS model_rows, {keys('m')} AS model_distinct_keys,
  count(*) - {keys('m')} AS model_duplicate_surplus_rows,
  count(debt_amount_usd) AS model_debt_priced_rows,
  count(collateral_amount_usd) AS model_collateral_priced_rows,
  CAST(round(sum(debt_usd_exact), 6) AS DECIMAL(38,6)) AS model_debt_usd_total,
  CAST(round(sum(collateral_usd_exact), 6) AS DECIMAL(38,6)) AS model_collateral_usd_total
 FROM liq_priced m)"""]
    for name, leg in (("debt_leg", debt), ("collateral_leg", collateral)):
        parts.append(f"""(SELECT count(*) AS {name}_rows, {keys('x')} AS {name}_distinct_keys,
  count(*) - {keys('x')} AS {name}_duplicate_surplus_rows,
  count(amount_usd) AS {name}_priced_rows FROM {leg} x)""")
    return "SELECT * FROM " + ", ".join(parts)


def _coverage(leg: str, side: str) -> str:
    return f"""
SELECT count_if(b.tx_hash IS NULL) AS model_without_{side}_keys,
  count_if(m.tx_hash IS NULL) AS {side}_without_model_keys
FROM (SELECT DISTINCT tx_hash, evt_index FROM liq_priced) m
FULL JOIN (SELECT DISTINCT tx_hash, evt_index FROM {leg}) b
  ON m.tx_hash = b.tx_hash AND m.evt_index = b.evt_index"""


def _report(debt: str, collateral: str, rec: str) -> str:
    counters = ["model_without_debt_keys", "debt_without_model_keys",
                "model_without_collateral_keys", "collateral_without_model_keys", *CHECKS]
    zero = " AND ".join(f"{c} = 0" for c in counters)
    same = " AND ".join(f"{s}_{k} = model_rows" for s in ("model", "debt_leg", "collateral_leg")
                        for k in ("rows", "distinct_keys"))
    sources = [_profiles(debt, collateral), _coverage(debt, "debt"),
               _coverage(collateral, "collateral"), _quality(rec),
               _top(rec, "left", "debt"), _top(rec, "right", "collateral")]
    return ("SELECT *, CASE WHEN model_rows > 0 AND " + same + " AND " + zero +
            " THEN 'PASS_EXACT_RECONCILIATION' ELSE 'REVIEW_DIFFERENCES' END "
            "AS reconciliation_status FROM " + ", ".join(f"({s})" for s in sources))  # fmt: skip


VIEWS = {
    "liq_raw": f"""
SELECT 1::BIGINT AS contract_address, o_orderdate AS evt_block_time,
  date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) AS evt_block_number,
  o_orderkey AS evt_tx_hash, o_orderkey % 7 AS evt_index, o_custkey % 11 AS liquidator,
  o_custkey AS "user", {_asset("o_orderkey + 5")} AS collateralasset,
  {_asset("o_orderkey")} AS debtasset,
  CAST(CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 100 AS DECIMAL(38,0)) + o_orderkey % 1000
    AS DECIMAL(38,0)) AS liquidatedcollateralamount,
  CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 100 AS DECIMAL(38,0)) AS debttocover,
  o_orderkey % 40 = 0 AS receiveatoken
FROM orders""",
    "meta_all": f"""
SELECT 'chain_a' AS blockchain, p_partkey AS contract_address,
  CASE WHEN v = 1 THEN 'old ' || p_name ELSE p_name END AS symbol,
  {_decimals("p_partkey")} AS decimals,
  CASE WHEN v = 0 THEN DATE '2024-01-01' END AS _updated_at
FROM (SELECT *, unnest(CASE WHEN p_partkey % 10 = 0 THEN [0, 1] ELSE [0] END) AS v FROM part)""",
    "meta": """
SELECT * FROM meta_all QUALIFY row_number() OVER (PARTITION BY contract_address
  ORDER BY _updated_at DESC NULLS LAST, symbol) = 1""",
    "liq_model": """
SELECT r.evt_block_time AS block_time, r.evt_block_number AS block_number, r.evt_tx_hash AS tx_hash,
  r.evt_index, r.contract_address AS project_contract_address, r.liquidator, r.user AS borrower,
  r.collateralasset AS collateral_asset, r.debtasset AS debt_asset,
  c.symbol AS collateral_symbol, m.symbol AS debt_symbol, c.decimals AS collateral_decimals,
  m.decimals AS debt_decimals, r.liquidatedcollateralamount AS collateral_amount_raw,
  r.debttocover AS debt_amount_raw,
  CAST(r.liquidatedcollateralamount AS DOUBLE) / pow(10.0::DOUBLE, c.decimals) AS collateral_amount,
  CAST(r.debttocover AS DOUBLE) / pow(10.0::DOUBLE, m.decimals) AS debt_amount,
  r.receiveatoken AS receive_atoken
FROM liq_raw r LEFT JOIN meta c ON r.collateralasset = c.contract_address
LEFT JOIN meta m ON r.debtasset = m.contract_address""",
    "liq_prices": f"""
SELECT asset, bucket, CASE WHEN (asset + month(bucket)) % 5 <> 0 THEN price END AS price,
  CASE WHEN asset >= 0 AND asset % 4 <> 0 THEN {_decimals("asset")} END
  AS decimals
FROM (SELECT {_asset("o_custkey")} AS asset, date_trunc('month', o_orderdate) AS bucket,
  CAST(max(CAST(o_totalprice AS DECIMAL(18,2))) * CAST(0.01234567 AS DECIMAL(8,8)) AS DECIMAL(26,10))
   AS price FROM orders GROUP BY ALL)""",
    "liq_priced": """
SELECT m.*, d.price AS debt_price_usd, c.price AS collateral_price_usd,
""" + ",\n".join(
        f"  CAST({s}_amount_raw AS DOUBLE) / pow(10.0::DOUBLE, "
        f"coalesce({a}.decimals, {s}_decimals, 18)) * CAST({a}.price AS DOUBLE) "
        f"AS {s}_amount_usd,\n"
        # raw * price with ten places over the unit, as integers, rounded half up at 18 places
        f"  CAST((CAST({s}_amount_raw AS HUGEINT) * CAST({a}.price * 10000000000 AS HUGEINT) * 200000000 "
        f"+ CAST(pow(10, coalesce({a}.decimals, {s}_decimals, 18)) AS HUGEINT)) // (2 * CAST(pow(10, "
        f"coalesce({a}.decimals, {s}_decimals, 18)) AS HUGEINT)) AS DECIMAL(38,0)) "
        f"* CAST(0.000000000000000001 AS DECIMAL(18,18)) AS {s}_usd_exact,\n"
        f"  CASE WHEN {a}.price IS NULL THEN 'MISSING_PRICE' ELSE 'PRICED' END AS {s}_price_status"
        for s, a in (("debt", "d"), ("collateral", "c"))
    ) + """
FROM liq_model m
LEFT JOIN liq_prices d ON d.asset = m.debt_asset AND d.bucket = date_trunc('month', m.block_time)
LEFT JOIN liq_prices c ON c.asset = m.collateral_asset
  AND c.bucket = date_trunc('month', m.block_time)""",
    "debt_ok": _leg("debt", "borrower", "repayer"),
    "coll_ok": _leg("collateral", "depositor", "withdrawn_to"),
    "debt_all": _faulty("debt_ok", "repayer"),
    "coll_all": _faulty("coll_ok", "withdrawn_to"),
    "debt_bad": "SELECT * FROM debt_all WHERE project = 'lender'",
    "coll_bad": "SELECT * FROM coll_all WHERE project = 'lender'",
    "rec_bad": _reconciled("debt_bad", "coll_bad"),
    "rec_ok": _reconciled("debt_ok", "coll_ok"),
}


def query(name: str, oracle: str):
    def add(function):
        QUERIES[name] = function
        ORACLES[name] = with_views(oracle, VIEWS)
        return function
    return add


def model(spark: SparkSession, d: str) -> DataFrame:
    return lq.liquidation_model(
        td.liquidations_raw(spark, d), td.token_metadata(spark, d), td.FIRST_DAY, td.LAST_DAY
    )


def priced(spark: SparkSession, d: str) -> DataFrame:
    return lq.with_exact_usd(
        lq.liquidation_priced(model(spark, d), td.month_prices(spark, d), "month", WINDOW)
    )


def stored_priced(spark: SparkSession, d: str) -> DataFrame:
    """The priced model as a table; the model and both test legs read it."""
    return frozen_relation(priced(spark, d), "liquidations")


SIDES = {"debt": ("borrow_liquidation", "repayer"),
         "collateral": ("deposit_liquidation", "withdrawn_to")}


def all_legs(rows: DataFrame, faulty: bool) -> dict[str, DataFrame]:
    """Curated legs of every project."""
    legs = {s: td.leg_base(rows, s) for s in SIDES}
    if faulty:
        legs = {s: td.seed_faults(leg, SIDES[s][1]) for s, leg in legs.items()}
    return legs


def scoped_legs(rows: DataFrame, faulty: bool) -> list[DataFrame]:
    """Both legs of the project under comparison."""
    out = []
    for side, leg in all_legs(rows, faulty).items():
        kept = [c for c in leg.columns if c not in ("blockchain", "project", "version",
                                                    "transaction_type", "block_month")]
        out.append(scans.leg_scan(leg, td.LENDER, SIDES[side][0], td.FIRST_DAY, td.LAST_DAY, kept))
    return out


def reconciled(spark: SparkSession, d: str, faulty: bool = True) -> DataFrame:
    rows = stored_priced(spark, d)
    return lq.reconciled_rows(rows, *scoped_legs(rows, faulty))


LEG_COLUMNS = ["tx_hash", "evt_index", "block_number", "token_address", "repayer", "amount_raw",
               "amount_usd"]


@query("leg_scan", """
SELECT tx_hash, evt_index, block_number, token_address, repayer, amount_raw, amount_usd
FROM debt_bad WHERE block_time >= TIMESTAMP '1996-01-10' AND block_time < TIMESTAMP '2000-06-15'""")
def leg_scan(spark, d):
    leg = all_legs(priced(spark, d), True)["debt"]
    return scans.leg_scan(
        leg, td.LENDER, "borrow_liquidation", datetime(1996, 1, 10), datetime(2000, 6, 15),
        LEG_COLUMNS,
    )


@query("scale_raw_amount", """
SELECT tx_hash, evt_index, debt_amount, collateral_amount FROM liq_model""")
def scale_raw_amount(spark, d):
    return model(spark, d).select(*KEY, "debt_amount", "collateral_amount")


PRICED_COLUMNS = ["debt_amount_usd", "collateral_amount_usd", "debt_price_status",
                  "collateral_price_status"]


@query("leg_usd", f"SELECT tx_hash, evt_index, {', '.join(PRICED_COLUMNS)} FROM liq_priced")
def leg_usd(spark, d):
    rows = lq.liquidation_priced(model(spark, d), td.month_prices(spark, d), "month", WINDOW)
    return rows.select(*KEY, *PRICED_COLUMNS)


@query("role_dim_join", """
SELECT tx_hash, evt_index, debt_symbol, debt_decimals, collateral_symbol, collateral_decimals
FROM liq_model""")
def role_dim_join(spark, d):
    newest = enrich.latest_dimension_row(
        td.token_metadata(spark, d), ["contract_address"], "_updated_at", ["symbol"]
    )
    rows = enrich.role_dim_join(
        td.liquidations_raw(spark, d), newest, "contract_address",
        {"collateralasset": "collateral", "debtasset": "debt"}, ["symbol", "decimals"],
    )
    return rows.select(
        F.col("evt_tx_hash").alias("tx_hash"), "evt_index", "debt_symbol", "debt_decimals",
        "collateral_symbol", "collateral_decimals",
    )


@query("latest_dimension_row", "SELECT contract_address, symbol, decimals FROM meta")
def latest_dimension_row(spark, d):
    rows = enrich.latest_dimension_row(
        td.token_metadata(spark, d), ["contract_address"], "_updated_at", ["symbol"]
    )
    return rows.select("contract_address", "symbol", "decimals")


@query("two_leg_reconcile", """
SELECT tx_hash, evt_index, debt_amount_raw, left_found, left_amount_raw, left_amount_usd,
  right_found, right_amount_raw, right_amount_usd FROM rec_bad""")
def two_leg_reconcile(spark, d):
    return reconciled(spark, d).select(
        *KEY, "debt_amount_raw", "left_found", "left_amount_raw", "left_amount_usd",
        "right_found", "right_amount_raw", "right_amount_usd",
    )


@query("top_difference", _top("rec_bad", "left", "debt"))
def top_difference(spark, d):
    return lq.largest_difference(reconciled(spark, d), "left", "debt")


@query("leg_quality", _quality("rec_bad"))
def leg_quality(spark, d):
    return lq.leg_quality(reconciled(spark, d))


@query("leg_profiles", _profiles("debt_bad", "coll_bad"))
def leg_profiles(spark, d):
    rows = stored_priced(spark, d)
    return lq.leg_profiles(rows, *scoped_legs(rows, True))


@query("reconciliation_report", _report("debt_bad", "coll_bad", "rec_bad"))
def reconciliation_report(spark, d):
    rows = stored_priced(spark, d)
    return lq.reconciliation_report(rows, *scoped_legs(rows, True))


@query("liquidation_reconciliation", _report("debt_ok", "coll_ok", "rec_ok"))
def liquidation_reconciliation(spark, d):
    """The same report against legs without faults: every counter zero and a PASS."""
    rows = stored_priced(spark, d)
    return lq.reconciliation_report(rows, *scoped_legs(rows, False))


def _any(*parts: str) -> str:
    return " OR ".join(
        f"coalesce({c}, false)" for n, c in CHECKS.items() if any(p in n for p in parts)
    )


@query("closed_ledger", f"""
SELECT ledger_class, CASE WHEN max(sev) = 0 THEN 'EXACT_MATCH' ELSE 'DIFFERENCE' END AS ledger_side,
  count(*) AS event_keys,
  (SELECT count(*) FROM (SELECT DISTINCT tx_hash, evt_index FROM liq_model))
    - sum(count(*)) OVER ()::BIGINT AS partition_residual
FROM (SELECT tx_hash, evt_index, sev, c AS ledger_class FROM (
  SELECT *, CASE WHEN c IN ('FULLY_PRICED_EXACT', 'MATCHED_NULL_DEBT_PRICE',
    'MATCHED_NULL_COLLATERAL_PRICE', 'MATCHED_BOTH_LEGS_NULL') THEN 0 ELSE 1 END AS sev
  FROM (SELECT tx_hash, evt_index, CASE WHEN NOT (left_found AND right_found) THEN 'MISSING_LEG'
    WHEN {_any("block_number", "asset_mismatch", "borrower", "liquidator")} THEN 'STRUCTURE'
    WHEN {_any("raw_amount", "token_amount", "nonnegative")} THEN 'AMOUNT'
    WHEN {_any("null_status")} THEN 'PRICE_NULL_STATUS' WHEN {_any("usd_exact")} THEN 'PRICED_USD'
    WHEN debt_amount_usd IS NULL AND collateral_amount_usd IS NULL THEN 'MATCHED_BOTH_LEGS_NULL'
    WHEN debt_amount_usd IS NULL THEN 'MATCHED_NULL_DEBT_PRICE'
    WHEN collateral_amount_usd IS NULL THEN 'MATCHED_NULL_COLLATERAL_PRICE'
    ELSE 'FULLY_PRICED_EXACT' END AS c FROM rec_bad))
 QUALIFY row_number() OVER (PARTITION BY tx_hash, evt_index ORDER BY sev DESC, c DESC) = 1)
GROUP BY ledger_class""")
def closed_ledger(spark, d):
    return lq.closed_ledger(reconciled(spark, d), model(spark, d))


@query("model_acceptance", """
SELECT 0::BIGINT AS raw_only_keys, 0::BIGINT AS model_only_keys, n.*,
 0::BIGINT AS field_mismatch_keys, 0::BIGINT AS collateral_scaling_mismatches,
 0::BIGINT AS debt_scaling_mismatches, a.* FROM
(SELECT count(*) AS matched_keys, count_if(debt_amount IS NULL) AS null_debt_amounts,
  count_if(collateral_amount IS NULL) AS null_collateral_amounts,
  count_if(debt_amount_raw = 0) AS zero_raw_debt_amounts,
  count_if(collateral_amount_raw = 0) AS zero_raw_collateral_amounts FROM liq_model) n,
(SELECT count(*) AS relevant_assets, count_if(n IS NULL) AS assets_missing_metadata,
  CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS metadata_duplicate_surplus,
  count_if(k > 1) AS assets_with_decimal_conflicts
 FROM (SELECT DISTINCT unnest([collateralasset, debtasset]) AS asset FROM liq_raw) u
 LEFT JOIN (SELECT contract_address, count(*) AS n, count(DISTINCT decimals) AS k FROM meta_all
  GROUP BY 1) v ON v.contract_address = u.asset) a""")
def model_acceptance(spark, d):
    return lq.model_acceptance(
        td.liquidations_raw(spark, d), model(spark, d), td.token_metadata(spark, d)
    )


@query("missing_price_breakdown", """
SELECT leg, asset, symbol, count(*) AS event_rows FROM (
 SELECT 'debt' AS leg, debt_asset AS asset, debt_symbol AS symbol, debt_price_status AS s
 FROM liq_priced UNION ALL
 SELECT 'collateral', collateral_asset, collateral_symbol, collateral_price_status FROM liq_priced)
WHERE s = 'MISSING_PRICE' GROUP BY ALL""")
def missing_price_breakdown(spark, d):
    return lq.missing_price_breakdown(priced(spark, d))


@query("scope_exclusions", " UNION ALL ".join(f"""
SELECT '{name}' AS leg, x.project, count(*) AS excluded_rows, count(k.tx_hash) AS leaked_rows
FROM {view} x LEFT JOIN (SELECT DISTINCT tx_hash, evt_index FROM {view}
  WHERE project = 'lender' OR (project = 'lender_fork' AND tx_hash % 3 = 0)) k
 ON k.tx_hash = x.tx_hash AND k.evt_index = x.evt_index
WHERE x.project <> 'lender' GROUP BY ALL""" for name, view in (
    ("debt", "debt_all"), ("collateral", "coll_all"))))
def scope_exclusions(spark, d):
    """All compared events, with some rows of another project among them as a seeded leak."""
    legs = all_legs(stored_priced(spark, d), True)
    own = F.col("project") == td.LENDER["project"]
    leak = (F.col("project") == "lender_fork") & (F.col("tx_hash") % 3 == 0)
    compared = legs["debt"].where(own | leak)
    return lq.scope_exclusions(legs, compared, own)


@query("float_vs_decimal_totals", """
SELECT count(*) AS row_count, count(l) AS left_priced_rows, count(r) AS right_priced_rows,
  CAST(round(sum(x), 6) AS DECIMAL(38,6)) AS decimal_total,
  count_if(l IS DISTINCT FROM r) AS unequal_rows,
  coalesce(sum(l - r), 0) = 0 AS same_row_difference_is_zero,
  true AS double_total_within_tolerance, 'FLOAT_AGGREGATION_ARTIFACT' AS residual_class,
  true AS double_residual_is_tiny
FROM (SELECT debt_amount_usd AS l, abs(left_amount_usd) AS r, debt_usd_exact AS x FROM rec_ok)""")
def float_vs_decimal_totals(spark, d):
    rows = reconciled(spark, d, faulty=False).withColumn("leg_abs", F.abs("left_amount_usd"))
    return lq.float_vs_decimal_totals(rows, "debt_amount_usd", "leg_abs", "debt_usd_exact")


@query("flow_by_dimension", " UNION ALL ".join(f"""
SELECT '{name}' AS kind, {name} AS dimension, count(*) AS event_rows,
  count_if(debt_usd_exact IS NULL) AS unpriced_debt_rows,
  CAST(round(coalesce(sum(debt_usd_exact), CAST(0 AS DECIMAL(38,18))), 6) AS DECIMAL(38,6))
    AS debt_usd,
  CAST(round(coalesce(sum(collateral_usd_exact), CAST(0 AS DECIMAL(38,18))), 6) AS DECIMAL(38,6))
    AS collateral_usd
FROM liq_priced GROUP BY {name}""" for name in ("liquidator", "debt_asset")))
def flow_by_dimension(spark, d):
    rows = priced(spark, d)
    parts = [
        lq.flow_by_dimension(rows, name).select(F.lit(name).alias("kind"), "*")
        for name in ("liquidator", "debt_asset")
    ]
    return parts[0].unionByName(parts[1])


MODEL_COLUMNS = [
    "block_number", "tx_hash", "evt_index", "liquidator", "borrower", "collateral_asset",
    "debt_asset", "collateral_symbol", "debt_symbol", "collateral_decimals", "debt_decimals",
    "collateral_amount_raw", "debt_amount_raw", "collateral_amount", "debt_amount",
    "receive_atoken",
]


@query("liquidation_model", f"SELECT {', '.join(MODEL_COLUMNS)} FROM liq_model")
def liquidation_model(spark, d):
    return model(spark, d).select(*MODEL_COLUMNS)


@query("liquidation_priced", f"""
SELECT {', '.join(MODEL_COLUMNS)}, {', '.join(PRICED_COLUMNS)}, debt_price_usd,
  collateral_price_usd, debt_amount_usd AS liquidation_amount_usd, debt_usd_exact,
  collateral_usd_exact FROM liq_priced""")
def liquidation_priced(spark, d):
    return priced(spark, d).select(
        *MODEL_COLUMNS, *PRICED_COLUMNS, "debt_price_usd", "collateral_price_usd",
        "liquidation_amount_usd", "debt_usd_exact", "collateral_usd_exact",
    )
