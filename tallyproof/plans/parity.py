"""Baseline against optimised path of the fee model in one plan, with one gate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyproof.functions.decimals import six_dp
from tallyproof.operators.audit import with_gate
from tallyproof.operators.intervals import candidate_entities
from tallyproof.operators.digests import ranged_field_mismatch
from tallyproof.operators.reconcile import beside, coverage_columns, key_counts
from tallyproof.plans.fee_model import TRADE_COLUMNS, fee_rows
from tallyproof.plans.refresh import tagged_paths
from tallyproof.sources.tables import PARTITION

BASELINE = "BASELINE"
OPTIMIZED = "OPTIMIZED_FULL_REFRESH"
KEYS = ["tx_hash", "evt_index"]
MEASURES = ["fees_usd", "revenue_usd", "supply_side_fees_usd"]
FIELDS = [c for c in TRADE_COLUMNS if c not in KEYS]


def two_paths(
    baseline: DataFrame,
    optimized: DataFrame,
    pools: DataFrame,
    settings: DataFrame,
    prices: DataFrame,
    repair_scope: Column,
    segment: Column,
    grain: str = "minute",
    strategy: str = "auto",
) -> DataFrame:
    """Model rows of both paths from one source snapshot; every step is keyed by the path."""
    trades = tagged_paths({BASELINE: baseline, OPTIMIZED: optimized})
    entities = tagged_paths(
        {BASELINE: pools, OPTIMIZED: candidate_entities(pools, optimized, "pool")}
    )
    return fee_rows(
        trades, entities, settings, prices, repair_scope, segment, grain, strategy, ["model_path"]
    )


def _side(rows: DataFrame, path: str) -> DataFrame:
    return rows.where(F.col("model_path") == path).drop("model_path")


def _key_columns(name: str) -> list[Column]:
    count = F.col(f"{name}_rows_per_key")
    return [
        F.coalesce(F.sum(count), F.lit(0)).alias(f"{name}_rows"),
        F.count_if(count > 0).alias(f"{name}_distinct_keys"),
        F.coalesce(F.sum(F.when(count > 0, count - 1)), F.lit(0)).alias(
            f"{name}_duplicate_key_surplus_rows"
        ),
    ]


def source_parity(baseline: DataFrame, optimized: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key multisets of both source scans in one aggregate."""
    counts = key_counts(baseline, optimized, keys)
    named = counts.withColumns(
        {
            "source_baseline_rows_per_key": F.col("left_rows"),
            "source_optimized_rows_per_key": F.col("right_rows"),
        }
    )
    cover = coverage_columns(keys)
    return named.agg(
        *_key_columns("source_baseline"),
        *_key_columns("source_optimized"),
        cover["left_only_keys"].alias("source_baseline_only_keys"),
        cover["right_only_keys"].alias("source_optimized_only_keys"),
        cover["row_count_mismatch_keys"].alias("source_row_count_mismatch_keys"),
    )


def path_metrics(rows: DataFrame) -> DataFrame:
    """The rollup of both paths as one row, pivoted by path in one aggregate."""
    def of(path: str, prefix: str) -> list[Column]:
        here = F.col("model_path") == path
        fees = F.sum(F.when(here, F.col("fees_usd")))
        revenue = F.sum(F.when(here, F.col("revenue_usd")))
        supply = F.sum(F.when(here, F.col("supply_side_fees_usd")))
        residual = (fees - revenue).cast("decimal(38,18)") - supply
        return [
            F.count_if(here).alias(f"{prefix}_model_rows"),
            F.count_if(here & F.col("is_repaired")).alias(f"{prefix}_repaired_rows"),
            F.count_if(here & F.col("fee_base_usd").isNull()).alias(
                f"{prefix}_unpriced_fee_base_rows"
            ),
            F.count_if(here & F.col("is_repaired") & F.col("fee_base_usd").isNull()).alias(
                f"{prefix}_repaired_null_rows"
            ),
            six_dp(fees).alias(f"{prefix}_fees_usd"),
            six_dp(revenue).alias(f"{prefix}_revenue_usd"),
            six_dp(supply).alias(f"{prefix}_supply_side_fees_usd"),
            six_dp(residual.cast("decimal(38,18)")).alias(f"{prefix}_accounting_residual_usd"),
        ]

    return rows.agg(*of(BASELINE, "baseline"), *of(OPTIMIZED, "optimized"))


def parity_expectations() -> dict[str, str]:
    """The acceptance conditions, as data."""
    checks = {
        "source_rows": "source_baseline_rows > 0 AND source_baseline_rows = source_optimized_rows",
        "source_unique": "source_baseline_duplicate_key_surplus_rows = 0"
        " AND source_optimized_duplicate_key_surplus_rows = 0",
        "source_keys": "source_baseline_only_keys = 0 AND source_optimized_only_keys = 0"
        " AND source_row_count_mismatch_keys = 0",
        "model_rows": "baseline_model_rows = source_baseline_rows"
        " AND optimized_model_rows = source_optimized_rows",
        "model_keys": "left_only_keys = 0 AND right_only_keys = 0"
        " AND matched_keys = baseline_model_rows",
        "fields": "field_mismatch_keys = 0",
        "repaired": "baseline_repaired_rows = optimized_repaired_rows"
        " AND baseline_repaired_null_rows = 0 AND optimized_repaired_null_rows = 0",
        "unpriced": "baseline_unpriced_fee_base_rows = optimized_unpriced_fee_base_rows",
        "residual": "baseline_accounting_residual_usd = 0 AND optimized_accounting_residual_usd = 0",
    }
    for m in MEASURES:
        checks[f"{m}_rows"] = f"{m}_row_difference_sum = 0"
        checks[f"{m}_total"] = f"baseline_{m} = optimized_{m}"
    return checks


def parity_report(
    rows: DataFrame, baseline_source: DataFrame, optimized_source: DataFrame
) -> DataFrame:
    """Source parity, model parity, differences, residuals and the gate on one row.

    Rows are compared by digests of dates and key ranges first, and paired only where these differ.
    ``rows`` holds both paths and is read several times, so freeze it first when it is expensive.
    """
    sides = (_side(rows, BASELINE), _side(rows, OPTIMIZED))
    compared = ranged_field_mismatch(*sides, PARTITION, KEYS, FIELDS, MEASURES)
    kept = [
        "matched_keys", "left_only_keys", "right_only_keys", "field_mismatch_keys",
        *[f"{m}_row_difference_sum" for m in MEASURES],
    ]
    report = beside(
        source_parity(baseline_source, optimized_source, KEYS),
        path_metrics(rows),
        compared.select(*kept),
    )
    return with_gate(report, parity_expectations(), "same_snapshot_parity_pass")

