"""Event-level liquidation model, its pricing and the reconciliation with two curated legs."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyproof.functions.decimals import USD, exact_decimals, six_dp, units_times_price
from tallyproof.functions.formulas import (
    DEFAULT_DECIMALS,
    differs,
    leg_usd,
    price_status,
    scale_raw_amount,
)
from tallyproof.operators.enrich import (
    latest_dimension_row,
    minute_price_join,
    role_dim_join,
    two_leg_reconcile,
)
from tallyproof.operators.reconcile import beside, difference_counters, top_difference_columns
from tallyproof.sources.scans import partition_pruned_scan, prices_of_window

KEYS = ["tx_hash", "evt_index"]
SIDES = ("debt", "collateral")

# Verdict of the reconciliation and classes of the closed ledger.
PASS = "PASS_EXACT_RECONCILIATION"
REVIEW = "REVIEW_DIFFERENCES"
FULLY_PRICED = "FULLY_PRICED_EXACT"
NULL_DEBT = "MATCHED_NULL_DEBT_PRICE"
NULL_COLLATERAL = "MATCHED_NULL_COLLATERAL_PRICE"
NULL_BOTH = "MATCHED_BOTH_LEGS_NULL"


def liquidation_model(
    raw: DataFrame, metadata: DataFrame, start: datetime, end: datetime
) -> DataFrame:
    """One row per liquidation event with both assets described; unpriced."""
    rows = partition_pruned_scan(
        raw, {}, "evt_block_time", start, end, partition="evt_block_date"
    )
    newest = latest_dimension_row(metadata, ["contract_address"], "_updated_at", ["symbol"])
    described = role_dim_join(
        rows, newest, "contract_address",
        {"collateralasset": "collateral", "debtasset": "debt"}, ["symbol", "decimals"],
    )
    return described.select(
        F.col("evt_block_time").alias("block_time"),
        F.col("evt_block_number").alias("block_number"),
        F.col("evt_tx_hash").alias("tx_hash"),
        "evt_index",
        F.col("contract_address").alias("project_contract_address"),
        "liquidator",
        F.col("user").alias("borrower"),
        F.col("collateralasset").alias("collateral_asset"),
        F.col("debtasset").alias("debt_asset"),
        "collateral_symbol",
        "debt_symbol",
        "collateral_decimals",
        "debt_decimals",
        F.col("liquidatedcollateralamount").alias("collateral_amount_raw"),
        F.col("debttocover").alias("debt_amount_raw"),
        scale_raw_amount(
            F.col("liquidatedcollateralamount"), F.col("collateral_decimals")
        ).alias("collateral_amount"),
        scale_raw_amount(F.col("debttocover"), F.col("debt_decimals")).alias("debt_amount"),
        F.col("receiveatoken").alias("receive_atoken"),
    )


def exact_leg_usd(side: str) -> Column:
    """USD of a leg in DECIMAL at 18 places, for totals that a check may rely on.

    Amount and price keep all their digits. Resolve under ``exact_decimals``.
    """
    decimals = F.coalesce(
        F.col(f"{side}_price_decimals"), F.col(f"{side}_decimals"), F.lit(DEFAULT_DECIMALS)
    )
    return units_times_price(F.col(f"{side}_amount_raw"), decimals, F.col(f"{side}_price_usd"))


def liquidation_priced(
    model: DataFrame,
    prices: DataFrame,
    grain: str = "minute",
    window: tuple[datetime, datetime] | None = None,
) -> DataFrame:
    """Both legs priced at the event's time bucket; a missing price stays NULL.

    ``window`` is the model's own; the join does not imply it, so it bounds the price scan here.
    """
    out = model
    if window:
        prices = prices_of_window(prices, *window, grain)
    for side in SIDES:
        values = {"price": f"{side}_price_usd", "decimals": f"{side}_price_decimals"}
        out = minute_price_join(out, prices, f"{side}_asset", "block_time", values, grain)
    for side in SIDES:
        price = F.col(f"{side}_price_usd")
        out = out.withColumn(
            f"{side}_amount_usd",
            leg_usd(
                F.col(f"{side}_amount_raw"), price,
                F.col(f"{side}_price_decimals"), F.col(f"{side}_decimals"),
            ),
        ).withColumn(f"{side}_price_status", price_status(price))
    return out.withColumn("liquidation_amount_usd", F.col("debt_amount_usd"))


def with_exact_usd(priced: DataFrame) -> DataFrame:
    with exact_decimals(priced.sparkSession):
        return priced.withColumns({f"{s}_usd_exact": exact_leg_usd(s) for s in SIDES})


def _leg_specs(prefix: str, side: str, parties: tuple[str, str]) -> dict[str, Column]:
    """Nine mismatch counters of one leg; curated amounts are signed."""
    found = F.col(f"{prefix}_found")

    def leg(name: str) -> Column:
        return F.col(f"{prefix}_{name}")

    owner, payer = parties
    usd, amount = F.col(f"{side}_amount_usd"), F.col(f"{side}_amount")
    return {
        f"{side}_block_number_mismatch_rows": found
        & differs(F.col("block_number"), leg("block_number")),
        f"{side}_asset_mismatch_rows": found
        & differs(F.col(f"{side}_asset"), leg("token_address")),
        f"{side}_borrower_mismatch_rows": found & differs(F.col("borrower"), leg(owner)),
        f"{side}_liquidator_mapping_mismatch_rows": found
        & (
            differs(F.col("liquidator"), leg("liquidator"))
            | differs(F.col("liquidator"), leg(payer))
        ),
        f"{side}_raw_amount_mismatch_rows": found
        & differs(F.col(f"{side}_amount_raw"), leg("amount_raw")),
        f"{side}_token_amount_exact_mismatch_rows": found & differs(amount, F.abs(leg("amount"))),
        f"{side}_nonnegative_signed_amount_rows": found & (leg("amount") >= 0),
        f"{side}_usd_null_status_mismatch_rows": found
        & (usd.isNull() != leg("amount_usd").isNull()),
        f"{side}_usd_exact_mismatch_rows": found & differs(usd, F.abs(leg("amount_usd"))),
    }


def leg_quality_spec() -> dict[str, Column]:
    return {
        **_leg_specs("left", "debt", ("borrower", "repayer")),
        **_leg_specs("right", "collateral", ("depositor", "withdrawn_to")),
    }


def leg_quality(reconciled: DataFrame) -> DataFrame:
    """The 18 named mismatch counters on one row."""
    return reconciled.agg(*difference_counters(leg_quality_spec()))


def reconciled_rows(model: DataFrame, debt: DataFrame, collateral: DataFrame) -> DataFrame:
    return two_leg_reconcile(model, debt, collateral, KEYS)


SOURCES = ("model", "debt_leg", "collateral_leg")


def event_counts(model: DataFrame, debt: DataFrame, collateral: DataFrame) -> DataFrame:
    """Rows, priced rows and exact totals of the model and both legs per event key.

    One union and one partially aggregated shuffle serve the profiles and the key coverage.
    """
    measures = {
        "model_rows": None,
        "debt_leg_rows": None,
        "collateral_leg_rows": None,
        "model_debt_priced_rows": "debt_amount_usd",
        "model_collateral_priced_rows": "collateral_amount_usd",
        "debt_leg_priced_rows": "amount_usd",
        "collateral_leg_priced_rows": "amount_usd",
        "model_debt_usd_total": "debt_usd_exact",
        "model_collateral_usd_total": "collateral_usd_exact",
    }

    def measure(name: str, column: str | None, source: str) -> Column:
        total = name.endswith("total")
        if not name.startswith(source):
            value = F.lit(None if total else 0)
        elif total:
            value = F.col(column)
        else:
            value = F.lit(1) if column is None else F.col(column).isNotNull().cast("bigint")
        return value.cast(USD if total else "bigint").alias(name)

    out = None
    for source, df in zip(SOURCES, (model, debt, collateral), strict=True):
        part = df.select(*KEYS, *[measure(n, c, source) for n, c in measures.items()])
        out = part if out is None else out.unionByName(part)
    return out.groupBy(*KEYS).agg(*[F.sum(n).alias(n) for n in measures])


def profile_columns() -> list[Column]:
    """Rows, distinct keys, duplicate surplus, priced rows and totals over ``event_counts``."""
    out = []
    for source in SOURCES:
        rows = F.col(f"{source}_rows")
        out += [
            F.coalesce(F.sum(rows), F.lit(0)).alias(f"{source}_rows"),
            F.count_if(rows > 0).alias(f"{source}_distinct_keys"),
            F.coalesce(F.sum(F.when(rows > 0, rows - 1)), F.lit(0)).alias(
                f"{source}_duplicate_surplus_rows"
            ),
        ]
    priced = ("model_debt", "model_collateral", "debt_leg", "collateral_leg")
    out += [
        F.coalesce(F.sum(f"{p}_priced_rows"), F.lit(0)).alias(f"{p}_priced_rows") for p in priced
    ]
    return out + [
        six_dp(F.sum(f"model_{s}_usd_total")).alias(f"model_{s}_usd_total") for s in SIDES
    ]


def coverage_of_legs() -> dict[str, Column]:
    """Keys without a counterpart, in both directions and for both legs."""
    on_model = F.col("model_rows") > 0
    out = {}
    for side in SIDES:
        on_leg = F.col(f"{side}_leg_rows") > 0
        out[f"model_without_{side}_keys"] = F.count_if(on_model & ~on_leg)
        out[f"{side}_without_model_keys"] = F.count_if(on_leg & ~on_model)
    return out


def leg_profiles(model: DataFrame, debt: DataFrame, collateral: DataFrame) -> DataFrame:
    """Profiles of the model and both legs on one row; totals in DECIMAL."""
    return event_counts(model, debt, collateral).agg(*profile_columns())


def usd_difference(prefix: str, side: str) -> Column:
    """Absolute USD difference of rows that are priced on both sides and disagree."""
    usd, other = F.col(f"{side}_amount_usd"), F.abs(F.col(f"{prefix}_amount_usd"))
    return F.when(F.col(f"{prefix}_found") & (usd != other), F.abs(usd - other))


def largest_difference_columns(prefix: str, side: str) -> list[Column]:
    show = {
        "tx_hash": F.concat(F.lit("0x"), F.hex("tx_hash")),
        "evt_index": F.col("evt_index"),
        "symbol": F.col(f"{side}_symbol"),
        "model_usd": F.col(f"{side}_amount_usd"),
        "leg_usd_abs": F.abs(F.col(f"{prefix}_amount_usd")),
    }
    order = ["block_time", "tx_hash", "evt_index"]
    return top_difference_columns(usd_difference(prefix, side), order, show, f"max_{side}_diff")


def largest_difference(reconciled: DataFrame, prefix: str, side: str) -> DataFrame:
    return reconciled.agg(*largest_difference_columns(prefix, side))


def verdict(counters: Sequence[str]) -> Column:
    """PASS only when every counter is zero and all three sides hold the same events."""
    clean = F.col("model_rows") > 0
    for side in SOURCES:
        clean = clean & (F.col(f"{side}_rows") == F.col("model_rows"))
        clean = clean & (F.col(f"{side}_distinct_keys") == F.col("model_rows"))
    for name in counters:
        clean = clean & (F.col(name) == 0)
    return F.when(clean, PASS).otherwise(REVIEW)


def reconciliation_report(model: DataFrame, debt: DataFrame, collateral: DataFrame) -> DataFrame:
    """Profiles, coverage, 18 counters, largest differences and the verdict on one row.

    Two aggregates: one over the event keys of all three sides, one over the joined rows. The
    expected row count is the model's own, since counts are observations of a snapshot.
    """
    coverage, quality = coverage_of_legs(), leg_quality_spec()
    keys = event_counts(model, debt, collateral).agg(
        *profile_columns(), *[c.alias(n) for n, c in coverage.items()]
    )
    joined = reconciled_rows(model, debt, collateral).agg(
        *difference_counters(quality),
        *largest_difference_columns("left", "debt"),
        *largest_difference_columns("right", "collateral"),
    )
    return beside(keys, joined).withColumn(
        "reconciliation_status", verdict([*coverage, *quality])
    )


def ledger_class() -> Column:
    """Exact keys by price status, differences by the first class that applies."""
    spec = leg_quality_spec()
    both = F.col("left_found") & F.col("right_found")

    def any_of(*parts: str) -> Column:
        hit = F.lit(False)
        for name, cond in spec.items():
            if any(p in name for p in parts):
                hit = hit | F.coalesce(cond, F.lit(False))
        return hit

    no_debt = F.col("debt_amount_usd").isNull()
    no_collateral = F.col("collateral_amount_usd").isNull()
    return (
        F.when(~both, "MISSING_LEG")
        .when(any_of("block_number", "asset_mismatch", "borrower", "liquidator"), "STRUCTURE")
        .when(any_of("raw_amount", "token_amount", "nonnegative"), "AMOUNT")
        .when(any_of("null_status"), "PRICE_NULL_STATUS")
        .when(any_of("usd_exact"), "PRICED_USD")
        .when(no_debt & no_collateral, NULL_BOTH)
        .when(no_debt, NULL_DEBT)
        .when(no_collateral, NULL_COLLATERAL)
        .otherwise(FULLY_PRICED)
    )


def closed_ledger(reconciled: DataFrame, model: DataFrame) -> DataFrame:
    """Every key in exactly one class; several rows of a key count once, by the worst class.

    The residual is the number of distinct keys of the model, counted without the join, less the
    classified keys; it must be zero.
    """
    exact = [FULLY_PRICED, NULL_DEBT, NULL_COLLATERAL, NULL_BOTH]
    code = ledger_class()
    per_key = (
        reconciled.select(*KEYS, code.alias("c"))
        .withColumn("severity", F.when(F.col("c").isin(exact), 0).otherwise(1))
        .groupBy(*KEYS)
        .agg(F.max(F.struct("severity", "c")).alias("m"))
    )
    counts = per_key.groupBy(F.col("m.c").alias("ledger_class")).agg(
        F.count("*").alias("event_keys"), F.max(F.col("m.severity")).alias("_s")
    )
    total = model.select(*KEYS).distinct().agg(F.count("*").alias("all_keys"))
    summed = counts.agg(F.coalesce(F.sum("event_keys"), F.lit(0)).alias("classified_keys"))
    check = beside(total, summed).select(
        (F.col("all_keys") - F.col("classified_keys")).alias("partition_residual")
    )
    return beside(counts, check).select(
        "ledger_class",
        F.when(F.col("_s") == 0, "EXACT_MATCH").otherwise("DIFFERENCE").alias("ledger_side"),
        "event_keys",
        "partition_residual",
    )


def model_acceptance(raw: DataFrame, model: DataFrame, metadata: DataFrame) -> DataFrame:
    """Raw to model: key parity, field mismatches, metadata and scaling checks on one row."""
    named = raw.select(
        F.col("evt_tx_hash").alias("tx_hash"),
        "evt_index",
        F.struct(
            F.col("evt_block_number").alias("block_number"),
            "liquidator",
            F.col("user").alias("borrower"),
            F.col("collateralasset").alias("collateral_asset"),
            F.col("debtasset").alias("debt_asset"),
            F.col("liquidatedcollateralamount").alias("collateral_amount_raw"),
            F.col("debttocover").alias("debt_amount_raw"),
            F.col("receiveatoken").alias("receive_atoken"),
        ).alias("r"),
    )
    fields = named.schema["r"].dataType.names
    rows = named.join(
        model.select(
            *KEYS, F.struct(*fields).alias("m"),
            *[f"{s}_{c}" for s in SIDES for c in ("amount", "decimals")],
        ),
        KEYS, "full_outer",
    )
    both = F.col("r").isNotNull() & F.col("m").isNotNull()
    unequal = F.lit(False)
    for f in fields:
        unequal = unequal | differs(F.col("r")[f], F.col("m")[f])

    def misscaled(side: str) -> Column:
        again = scale_raw_amount(F.col("r")[f"{side}_amount_raw"], F.col(f"{side}_decimals"))
        return both & differs(F.col(f"{side}_amount"), again)

    checks = {
        "raw_only_keys": F.col("m").isNull(),
        "model_only_keys": F.col("r").isNull(),
        "matched_keys": both,
        "field_mismatch_keys": both & unequal,
        **{f"null_{s}_amounts": both & F.col(f"{s}_amount").isNull() for s in SIDES},
        **{f"{s}_scaling_mismatches": misscaled(s) for s in SIDES},
        **{f"zero_raw_{s}_amounts": F.col("r")[f"{s}_amount_raw"] == 0 for s in SIDES},
    }
    totals = rows.agg(*[F.count_if(c).alias(n) for n, c in checks.items()])

    used = raw.select(F.explode(F.array("collateralasset", "debtasset")).alias("asset")).distinct()
    versions = metadata.groupBy(F.col("contract_address").alias("asset")).agg(
        F.count("*").alias("n"), F.count_distinct("decimals").alias("d")
    )
    assets = used.join(versions, "asset", "left").agg(
        F.count("*").alias("relevant_assets"),
        F.count_if(F.col("n").isNull()).alias("assets_missing_metadata"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("metadata_duplicate_surplus"),
        F.count_if(F.col("d") > 1).alias("assets_with_decimal_conflicts"),
    )
    return beside(totals, assets)


def missing_price_breakdown(priced: DataFrame) -> DataFrame:
    """Events without a price per asset and leg."""
    legs = F.array(
        *[
            F.struct(
                F.lit(s).alias("leg"),
                F.col(f"{s}_asset").alias("asset"),
                F.col(f"{s}_symbol").alias("symbol"),
                F.col(f"{s}_price_status").alias("status"),
            )
            for s in SIDES
        ]
    )
    return (
        priced.select(F.explode(legs).alias("l"))
        .where(F.col("l.status") == "MISSING_PRICE")
        .groupBy("l.leg", "l.asset", "l.symbol")
        .agg(F.count("*").alias("event_rows"))
    )


def scope_exclusions(
    legs: dict[str, DataFrame], compared: DataFrame, in_scope: Column, keys: Sequence[str] = KEYS
) -> DataFrame:
    """Out-of-scope rows per project and leg, and how many of their keys were compared."""
    out = None
    marks = compared.select(*keys).distinct().withColumn("_in", F.lit(1))
    for name, leg in legs.items():
        part = (
            leg.where(~in_scope)
            .join(marks, list(keys), "left")
            .groupBy(F.lit(name).alias("leg"), "project")
            .agg(F.count("*").alias("excluded_rows"), F.count("_in").alias("leaked_rows"))
        )
        out = part if out is None else out.unionByName(part)
    return out


def float_vs_decimal_totals(pairs: DataFrame, left: str, right: str, exact: str) -> DataFrame:
    """Totals of one measure in DOUBLE and DECIMAL on both sides, and the artefact class.

    ``left`` and ``right`` are DOUBLE columns of the same rows, ``exact`` a DECIMAL twin. DOUBLE
    totals depend on the order of addition and are reported as agreement within a tolerance.
    """
    same_row = F.sum(
        F.when(F.col(left).isNotNull() & F.col(right).isNotNull(), F.col(left) - F.col(right))
    )
    residual = F.sum(left) - F.sum(right)
    drift = F.abs(F.sum(left) - F.sum(exact).cast("double"))
    close = drift <= F.greatest(F.abs(F.sum(left)), F.lit(1.0)) * F.lit(1e-12) * F.count("*")
    unequal = F.count_if(differs(F.col(left), F.col(right)))
    return pairs.agg(
        F.count("*").alias("row_count"),
        F.count(left).alias("left_priced_rows"),
        F.count(right).alias("right_priced_rows"),
        six_dp(F.sum(F.col(exact).cast(USD))).alias("decimal_total"),
        unequal.alias("unequal_rows"),
        (same_row == 0.0).alias("same_row_difference_is_zero"),
        close.alias("double_total_within_tolerance"),
        F.when((unequal == 0) & close, "FLOAT_AGGREGATION_ARTIFACT")
        .when(unequal == 0, "UNEXPLAINED")
        .otherwise("EVENT_DIFFERENCE")
        .alias("residual_class"),
        F.coalesce(F.abs(residual) <= F.lit(1e-3), F.lit(True)).alias("double_residual_is_tiny"),
    )


def flow_by_dimension(priced: DataFrame, dimension: str) -> DataFrame:
    """Events and exact USD totals per liquidator or asset; unpriced legs are counted."""
    return priced.groupBy(F.col(dimension).alias("dimension")).agg(
        F.count("*").alias("event_rows"),
        F.count_if(F.col("debt_usd_exact").isNull()).alias("unpriced_debt_rows"),
        six_dp(F.coalesce(F.sum("debt_usd_exact"), F.lit(0))).alias("debt_usd"),
        six_dp(F.coalesce(F.sum("collateral_usd_exact"), F.lit(0))).alias("collateral_usd"),
    )

