"""Key coverage, row comparison and leg reconciliation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyproof.functions.decimals import USD, dec, exact_decimals, six_dp, usd
from tallyproof.functions.formulas import differs
from tallyproof.operators.ordered import first_per_key
from tallyproof.operators.sides import sized_side


def dedupe_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """First row per key in a total order, so that a later join cannot fan out."""
    return first_per_key(df, keys, order)


def key_counts(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows per key on both sides: ``left_rows`` and ``right_rows``.

    One union and one partially aggregated shuffle replace two DISTINCTs and a full outer join,
    and a key with very many rows shrinks before it moves.
    """
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    tagged = left.select(*keys, one.alias("l"), none.alias("r")).unionByName(
        right.select(*keys, none.alias("l"), one.alias("r"))
    )
    return tagged.groupBy(*keys).agg(F.sum("l").alias("left_rows"), F.sum("r").alias("right_rows"))


def coverage_columns(keys: Sequence[str]) -> dict[str, Column]:
    """Counters over ``key_counts``; a NULL key part matches nothing, as in a join."""
    on_left, on_right = F.col("left_rows") > 0, F.col("right_rows") > 0
    complete = reduce(and_, [F.col(k).isNotNull() for k in keys])
    both = on_left & on_right & complete
    return {
        "matched_keys": F.count_if(both),
        "left_only_keys": F.count_if(on_left & ~both),
        "right_only_keys": F.count_if(on_right & ~both),
        "row_count_mismatch_keys": F.count_if(both & (F.col("left_rows") != F.col("right_rows"))),
    }


def key_coverage(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Matched, left-only and right-only distinct keys."""
    counters = coverage_columns(keys)
    counters.pop("row_count_mismatch_keys")
    return key_counts(left, right, keys).agg(*[c.alias(n) for n, c in counters.items()])


def key_multiset_coverage(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``key_coverage`` plus keys whose row counts differ."""
    counters = coverage_columns(keys)
    return key_counts(left, right, keys).agg(*[c.alias(n) for n, c in counters.items()])


def key_audit(df: DataFrame, keys: Sequence[str], unpriced: str | None = None) -> DataFrame:
    """Rows, distinct composite keys, duplicate surplus, null-key and unpriced rows.

    Counts per key first, so no distinct set is ever built in one place.
    """
    missing = reduce(or_, [F.col(k).isNull() for k in keys])
    priced = F.count_if(F.col(unpriced).isNull()) if unpriced else F.lit(0).cast("bigint")
    per_key = df.groupBy(*keys).agg(F.count("*").alias("n"), priced.alias("unpriced"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
        F.count("*").alias("distinct_keys"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_surplus_rows"),
        F.coalesce(F.sum(F.when(missing, F.col("n"))), F.lit(0)).alias("null_key_rows"),
        F.coalesce(F.sum("unpriced"), F.lit(0)).alias("unpriced_rows"),
    )


def paired(
    left: DataFrame, right: DataFrame, keys: Sequence[str], fields: Sequence[str]
) -> DataFrame:
    """Full outer pairing of two sides with unique keys: ``l`` and ``r`` structs of the fields."""
    a = left.select(*keys, F.struct(*fields).alias("l"))
    b = right.select(*keys, F.struct(*fields).alias("r"))
    return a.join(b, list(keys), "full_outer")


def field_mismatch(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    fields: Sequence[str],
    measures: Sequence[str] = (),
) -> DataFrame:
    """Null-safe comparison of every field of every key, with row-difference sums."""
    rows = paired(left, right, keys, [*fields, *[m for m in measures if m not in fields]])
    both = F.col("l").isNotNull() & F.col("r").isNotNull()
    unequal = {f: both & differs(F.col("l")[f], F.col("r")[f]) for f in fields}
    zero = dec(0, USD)
    gaps = {
        m: usd(F.coalesce(usd(F.col("l")[m]), zero) - F.coalesce(usd(F.col("r")[m]), zero))
        for m in measures
    }
    with exact_decimals(rows.sparkSession):
        return rows.agg(
            F.count_if(both).alias("matched_keys"),
            F.count_if(F.col("r").isNull()).alias("left_only_keys"),
            F.count_if(F.col("l").isNull()).alias("right_only_keys"),
            F.count_if(reduce(or_, unequal.values())).alias("field_mismatch_keys"),
            *[F.count_if(c).alias(f"{f}_mismatch_keys") for f, c in unequal.items()],
            *[six_dp(F.sum(c)).alias(f"{m}_row_difference_sum") for m, c in gaps.items()],
        )


def changed_set_diff(
    expected: DataFrame, actual: DataFrame, keys: Sequence[str], value: str, reason: str
) -> DataFrame:
    """Expected against actual change set, in both failure directions."""
    rows = paired(expected, actual, keys, [value, reason])
    both = F.col("l").isNotNull() & F.col("r").isNotNull()
    return rows.agg(
        F.count_if(both).alias("matched_changed_rows"),
        F.count_if(F.col("r").isNull()).alias("missing_expected_rows"),
        F.count_if(F.col("l").isNull()).alias("unexpected_actual_changed_rows"),
        F.count_if(both & differs(F.col("l")[value], F.col("r")[value])).alias(
            "fixed_value_mismatch_rows"
        ),
        F.count_if(both & differs(F.col("l")[reason], F.col("r")[reason])).alias(
            "reason_code_mismatch_rows"
        ),
    )


def row_diff(
    base: DataFrame,
    changed: DataFrame,
    expected: DataFrame,
    keys: Sequence[str],
    before: str,
    after: str,
) -> DataFrame:
    """Before and after value of every row, classified over the whole population.

    Both change sets hold one row per key. They are combined into one side first, so the
    population meets one join, by broadcast if the counted side is small.
    """
    marks, _ = sized_side(
        paired(changed, expected, keys, [after]).select(
            *keys,
            F.col("l").isNotNull().alias("_changed"),
            F.col("r").isNotNull().alias("_expected"),
            F.col("l")[after].alias("_after"),
        )
    )
    rows = base.join(marks, list(keys), "left")
    old = F.col(before)
    new = F.when(F.col("_changed"), F.col("_after")).otherwise(old)
    flagged = F.coalesce(F.col("_expected"), F.lit(False))
    moved = differs(old, new)
    counters = {
        "model_rows": F.count("*"),
        "model_changed_rows": F.count_if(moved),
        "changed_expected_rows": F.count_if(flagged & moved),
        "expected_rows_not_changed": F.count_if(flagged & ~moved),
        "changed_unaffected_rows": F.count_if(~flagged & moved),
        "unchanged_unaffected_rows": F.count_if(~flagged & ~moved),
        "before_null_rows": F.count_if(old.isNull()),
        "after_null_rows": F.count_if(new.isNull()),
        "newly_null_rows": F.count_if(old.isNotNull() & new.isNull()),
        "unexpectedly_filled_null_rows": F.count_if(old.isNull() & new.isNotNull()),
    }
    return rows.agg(*[c.alias(n) for n, c in counters.items()])


def expected_set_profile(
    df: DataFrame, keys: Sequence[str], value: str, reason: str, number: str, codes: Sequence[str]
) -> DataFrame:
    """Profile of a frozen change set: keys, reasons, null values and row numbers."""
    known = F.coalesce(F.col(reason).isin(list(codes)), F.lit(False))
    per_code = [
        F.count_if(F.col(reason) == code).alias(f"reason_{i}_rows") for i, code in enumerate(codes)
    ]
    keys_seen = df.groupBy(*keys).count().agg(F.count("*").alias("distinct_keys"))
    totals = df.agg(
        F.count("*").alias("row_count"),
        *per_code,
        F.count_if(~known).alias("unexpected_reason_rows"),
        F.count_if(F.col(value).isNull()).alias("null_value_rows"),
        F.min(number).alias("min_row_number"),
        F.max(number).alias("max_row_number"),
        F.count_distinct(number).alias("distinct_row_numbers"),
    )
    return beside(totals, keys_seen).withColumn(
        "duplicate_surplus_rows", F.col("row_count") - F.col("distinct_keys")
    )


def beside(*one_row: DataFrame) -> DataFrame:
    """Put one-row results next to each other."""
    return reduce(lambda a, b: a.crossJoin(b), one_row)


def difference_counters(spec: Mapping[str, Column]) -> list[Column]:
    return [F.count_if(cond).alias(name) for name, cond in spec.items()]


def top_difference_columns(
    difference: Column, order: Sequence[str], show: Mapping[str, Column], prefix: str
) -> list[Column]:
    """Aggregates for the largest difference and its row; all NULL when nothing differs.

    ``min_by`` aggregates partially, so no ranking of the whole set is needed. Ties go to the
    first row in ``order``.
    """
    rank = F.when(difference.isNotNull(), F.struct((-difference).alias("_neg"), *order))
    return [
        F.max(difference).alias(f"{prefix}_abs_diff"),
        *[F.min_by(c, rank).alias(f"{prefix}_{name}") for name, c in show.items()],
    ]


def top_difference(
    df: DataFrame, difference: Column, order: Sequence[str], show: Mapping[str, Column], prefix: str
) -> DataFrame:
    """The largest difference and its row, pivoted to the columns of one row."""
    return df.agg(*top_difference_columns(difference, order, show, prefix))


def snapshot_drift(
    before: DataFrame,
    after: DataFrame,
    keys: Sequence[str],
    fields: Sequence[str],
    priced: str,
    updated: str | None = None,
    frozen_at: Column | None = None,
) -> DataFrame:
    """Rows added, removed and changed between two snapshots of one window."""
    extra = [updated] if updated else []
    rows = paired(before, after, keys, [*fields, *[c for c in (priced, *extra) if c not in fields]])
    both = F.col("l").isNotNull() & F.col("r").isNotNull()
    changed = both & reduce(or_, [differs(F.col("l")[f], F.col("r")[f]) for f in fields])
    filled = both & F.col("l")[priced].isNull() & F.col("r")[priced].isNotNull()
    late = F.lit(False)
    if updated and frozen_at is not None:
        late = F.coalesce(F.col("r")[updated] > frozen_at, F.lit(False))
    return rows.agg(
        F.count_if(F.col("l").isNull()).alias("added_rows"),
        F.count_if(F.col("r").isNull()).alias("removed_rows"),
        F.count_if(changed).alias("changed_rows"),
        F.count_if(both & ~changed).alias("unchanged_rows"),
        F.count_if(filled).alias("null_to_priced_rows"),
        F.count_if(late).alias("updated_after_freeze_rows"),
    )


def event_call_match(
    events: DataFrame, calls: DataFrame, entity: Sequence[str], amounts: Sequence[str]
) -> DataFrame:
    """Events against calls per entity key: exact, mismatched and unmatched counts.

    Only the result of this check is public. Here the n-th event of a key and amount matches the
    n-th such call; what is left of an entity key on both sides is a mismatch, the rest is
    unmatched. Counting per key gives the same numbers as pairing ordinals, without a pair.
    """
    per_amount = key_counts(events, calls, [*entity, *amounts]).withColumn(
        "exact", F.least("left_rows", "right_rows")
    )
    per_entity = per_amount.groupBy(*entity).agg(
        F.sum("exact").alias("exact"),
        F.sum(F.col("left_rows") - F.col("exact")).alias("events_left"),
        F.sum(F.col("right_rows") - F.col("exact")).alias("calls_left"),
    )
    wrong = F.least("events_left", "calls_left")
    return per_entity.agg(
        F.sum(F.col("exact") + F.col("events_left")).alias("event_rows"),
        F.sum(F.col("exact") + F.col("calls_left")).alias("call_rows"),
        F.sum("exact").alias("exact_matches"),
        F.sum(wrong).alias("amount_mismatches"),
        F.sum(F.col("events_left") - wrong).alias("events_without_call"),
        F.sum(F.col("calls_left") - wrong).alias("calls_without_event"),
    )


def raw_curated_reconcile(
    raw: DataFrame, curated: DataFrame, keys: Sequence[str], by: str, amount: str
) -> DataFrame:
    """Raw against curated transfers per token: rows, keys and exact integer amounts."""
    def side(df: DataFrame, mark: str) -> DataFrame:
        hit = F.lit(1).cast("bigint")
        none = F.lit(0).cast("bigint")
        value = F.col(amount).cast("decimal(38,0)")
        return df.select(
            *keys,
            by,
            (hit if mark == "l" else none).alias("l"),
            (hit if mark == "r" else none).alias("r"),
            (value if mark == "l" else dec(0, "decimal(38,0)")).alias("lv"),
            (value if mark == "r" else dec(0, "decimal(38,0)")).alias("rv"),
        )

    per_key = (
        side(raw, "l")
        .unionByName(side(curated, "r"))
        .groupBy(*keys, by)
        .agg(*[F.sum(c).alias(c) for c in ("l", "r", "lv", "rv")])
    )
    both = (F.col("l") > 0) & (F.col("r") > 0)
    return per_key.groupBy(by).agg(
        F.sum("l").alias("raw_rows"),
        F.sum("r").alias("curated_rows"),
        F.count_if(F.col("l") > 0).alias("raw_keys"),
        F.count_if(F.col("r") > 0).alias("curated_keys"),
        F.sum("lv").cast("decimal(38,0)").alias("raw_amount"),
        F.sum("rv").cast("decimal(38,0)").alias("curated_amount"),
        F.count_if(both).alias("matched_keys"),
        F.count_if(F.col("r") == 0).alias("raw_only_keys"),
        F.count_if(F.col("l") == 0).alias("curated_only_keys"),
        F.count_if(both & (F.col("l") != F.col("r"))).alias("row_count_mismatch_keys"),
        F.count_if(both & (F.col("lv") != F.col("rv"))).alias("amount_mismatch_keys"),
    )
