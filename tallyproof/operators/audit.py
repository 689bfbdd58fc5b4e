"""Gates, impact tables and metric comparisons over small result sets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyproof.functions.decimals import USD, dec, exact_decimals, percent, six_dp, usd

NOT_APPLICABLE = "not_applicable"


def regression_gate(
    metrics: DataFrame, expectations: Mapping[str, str], flag: str = "all_checks_pass"
) -> DataFrame:
    """One row per check with its outcome, and the conjunction of all checks on every row.

    ``expectations`` maps a check name to a condition over the one-row ``metrics``; an unknown
    outcome fails.
    """
    conditions = {n: F.coalesce(F.expr(c), F.lit(False)) for n, c in expectations.items()}
    checks = F.array(
        *[F.struct(F.lit(n).alias("n"), c.alias("p")) for n, c in conditions.items()]
    )
    return metrics.select(
        F.explode(checks).alias("c"), reduce(and_, conditions.values()).alias(flag)
    ).select(F.col("c.n").alias("check_name"), F.col("c.p").alias("passed"), flag)


def with_gate(metrics: DataFrame, expectations: Mapping[str, str], flag: str) -> DataFrame:
    """The metrics row with the conjunction as one boolean column."""
    met = [F.coalesce(F.expr(c), F.lit(False)) for c in expectations.values()]
    return metrics.withColumn(flag, reduce(and_, met))


def impact_table(
    rollup: DataFrame, tag: str, before: str, after: str, units: Mapping[str, str]
) -> DataFrame:
    """Before, after, absolute and relative change of each metric.

    ``rollup`` has one row per variant, told apart by ``tag``; it is read once. The relative change
    is text with four places, and ``not_applicable`` from a zero base.
    """
    pairs = F.create_map(*[F.lit(x) for kv in units.items() for x in kv])
    cells = F.array(
        *[F.struct(F.lit(n).alias("m"), F.col(n).cast("decimal(38,6)").alias("v")) for n in units]
    )

    def of(variant: str) -> Column:
        return F.max(F.when(F.col(tag) == variant, F.col("c.v")))

    rows = (
        rollup.select(tag, F.explode(cells).alias("c"))
        .groupBy(F.col("c.m").alias("metric"))
        .agg(of(before).alias("before_value"), of(after).alias("after_value"))
    )
    change = (F.col("after_value") - F.col("before_value")).cast("decimal(38,6)")
    relative = percent_text(change, F.col("before_value"))
    return rows.select(
        "metric", F.element_at(pairs, F.col("metric")).alias("unit"), "before_value", "after_value",
        change.alias("absolute_change"), relative.alias("percentage_change"),
    )


def percent_text(change: Column, base: Column) -> Column:
    text = F.concat(percent(change, base, 4, 6).cast("string"), F.lit("%"))
    return F.when(base == 0, NOT_APPLICABLE).otherwise(text)


def display_residual(rows: DataFrame) -> DataFrame:
    """Residual of the unrounded totals next to the residual of the displayed ones."""
    fees, revenue, supply = (
        F.sum("fees_usd"), F.sum("revenue_usd"), F.sum("supply_side_fees_usd"),
    )
    shown = six_dp(six_dp(fees) - six_dp(supply) - six_dp(revenue))
    exact = six_dp(usd(usd(fees - supply) - revenue))
    residual_class = (
        F.when((shown != 0) & (exact == 0), "DISPLAY_ROUNDING_6DP")
        .when(exact == 0, "NONE")
        .otherwise("ACCOUNTING")
    )
    with exact_decimals(SparkSession.active()):
        return rows.agg(
            shown.alias("display_residual_usd"),
            exact.alias("unrounded_residual_usd"),
            residual_class.alias("residual_class"),
        )


def scan_reduction(paths: Mapping[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """Rows admitted by the full and the reduced path of each input, and the reduction."""
    parts = []
    for name, (full, reduced) in paths.items():
        both = full.select(F.lit(1).alias("f"), F.lit(0).alias("r")).unionByName(
            reduced.select(F.lit(0).alias("f"), F.lit(1).alias("r"))
        )
        sums = both.agg(
            F.coalesce(F.sum("f"), F.lit(0)).alias("full_rows"),
            F.coalesce(F.sum("r"), F.lit(0)).alias("reduced_rows"),
        )
        saved = F.col("full_rows") - F.col("reduced_rows")
        parts.append(
            sums.select(
                F.lit(name).alias("input"), "full_rows", "reduced_rows",
                percent(saved, F.col("full_rows"), 4).alias("reduction_pct"),
            )
        )
    return reduce(lambda a, b: a.unionByName(b), parts)


def external_metric_gap(
    own: DataFrame, external: DataFrame, keys: Sequence[str], metric: str, published: str
) -> DataFrame:
    """Own metric against a published one, per key: gap and percent of the published value.

    Only the result of this comparison is public; keys missing on one side stay visible and no
    cause is attributed.
    """
    rows = own.select(*keys, metric).join(external.select(*keys, published), list(keys), "full")
    gap = (F.col(metric) - F.col(published)).cast("decimal(38,6)")
    share = percent(gap, F.col(published), 4, 6)
    return rows.select(*keys, metric, published, gap.alias("gap"), share.alias("gap_pct"))


def accrual_vs_realised(
    accrued: DataFrame, withdrawals: DataFrame, key: str, accrued_value: str, realised_value: str
) -> DataFrame:
    """Accrued revenue against priced withdrawals per entity; unpriced ones stay visible.

    Both sides are summed per entity before they meet.
    """
    a = accrued.groupBy(key).agg(F.sum(usd(F.col(accrued_value))).alias("_a"))
    w = withdrawals.groupBy(key).agg(
        F.sum(usd(F.col(realised_value))).alias("_w"),
        F.count("*").alias("_n"),
        F.count_if(F.col(realised_value).isNull()).alias("_u"),
    )
    rows = a.join(w, key, "full_outer")
    zero = dec(0, USD)
    accrued_usd, realised_usd = F.coalesce("_a", zero), F.coalesce("_w", zero)
    with exact_decimals(rows.sparkSession):
        return rows.select(
            key,
            six_dp(accrued_usd).alias("accrued_usd"),
            six_dp(realised_usd).alias("realised_usd"),
            six_dp(usd(accrued_usd - realised_usd)).alias("gap_usd"),
            F.coalesce("_n", F.lit(0)).alias("withdrawals"),
            F.coalesce("_u", F.lit(0)).alias("unpriced_withdrawals"),
        )
