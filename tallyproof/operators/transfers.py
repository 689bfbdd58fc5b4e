"""Transfer netting, movement, qualification and per-pair behaviour features."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyproof.functions.decimals import RAW, bps, dec, percent, whole
from tallyproof.operators.ordered import Carry, carry, first_per_key, magnitude, running_total

# Columns that are constant within one transaction.
TX = ["block_time", "block_date", "block_number", "tx_index"]
# Total order of activity: block, transaction index, transaction hash, then token.
TX_ORDER = ["block_number", "tx_index", "tx_hash"]
PAIR = ["address", "token"]


def transfer_legs(transfers: DataFrame) -> DataFrame:
    """Two legs per transfer, read in one pass: the receiver's and the sender's."""
    none = dec(0, RAW)
    sides = F.array(
        F.struct(
            F.col("receiver").alias("address"),
            F.col("sender").alias("counterparty"),
            whole(F.col("value")).alias("incoming"),
            none.alias("outgoing"),
        ),
        F.struct(
            F.col("sender").alias("address"),
            F.col("receiver").alias("counterparty"),
            none.alias("incoming"),
            whole(F.col("value")).alias("outgoing"),
        ),
    )
    return transfers.select("token", "tx_hash", *TX, F.explode(sides).alias("l")).select(
        "token", "tx_hash", *TX, "l.*"
    )


def address_netting(transfers: DataFrame) -> DataFrame:
    """Signed net of each address per token and transaction."""
    return (
        transfer_legs(transfers)
        .groupBy("token", "tx_hash", "address")
        .agg(
            F.sum("incoming").alias("incoming_raw"),
            F.sum("outgoing").alias("outgoing_raw"),
            *[F.min(c).alias(c) for c in TX],
        )
        .withColumn("net_raw", whole(F.col("incoming_raw") - F.col("outgoing_raw")))
    )


def nonzero_groups(netting: DataFrame) -> DataFrame:
    """An address's transaction-token groups that moved something."""
    return netting.where(F.col("net_raw") != 0)


def tx_token_movement(netting: DataFrame) -> DataFrame:
    """Balanced movement per token and transaction: half the sum of absolute nets."""
    return (
        netting.groupBy("token", "tx_hash")
        .agg(
            F.sum(F.abs("net_raw")).alias("_abs"),
            F.sum("net_raw").alias("net_residual_raw"),
            F.sum("incoming_raw").alias("gross_raw"),
            F.sum("outgoing_raw").alias("outgoing_raw"),
        )
        .select(
            "token",
            "tx_hash",
            whole(F.floor(whole(F.col("_abs")) / 2)).alias("movement_raw"),
            whole(F.col("gross_raw")).alias("gross_raw"),
            whole(F.col("outgoing_raw")).alias("outgoing_raw"),
            whole(F.col("net_residual_raw")).alias("net_residual_raw"),
        )
    )


def movement_profile(movement: DataFrame) -> DataFrame:
    """Per token: groups, exact movement and gross, their ratio, and the three invariants."""
    moved, gross = F.sum("movement_raw"), F.sum("gross_raw")
    return movement.groupBy("token").agg(
        F.count("*").alias("token_groups"),
        F.count_if(F.col("movement_raw") > 0).alias("positive_groups"),
        F.count_if(F.col("movement_raw") == 0).alias("zero_groups"),
        whole(moved).alias("movement_raw"),
        whole(gross).alias("gross_raw"),
        percent(moved, gross, 4).alias("movement_of_gross_pct"),
        F.count_if(F.col("net_residual_raw") != 0).alias("nonzero_residual_groups"),
        F.count_if(F.col("gross_raw") != F.col("outgoing_raw")).alias("unbalanced_groups"),
        F.count_if(F.col("movement_raw") > F.col("gross_raw")).alias("movement_above_gross_groups"),
    )


def tx_movement(movement: DataFrame) -> DataFrame:
    """Combined movement of a transaction over its tokens."""
    return movement.groupBy("tx_hash").agg(whole(F.sum("movement_raw")).alias("movement_raw"))


def tx_movement_ledger(per_tx: DataFrame, fees: DataFrame) -> DataFrame:
    """Transactions by movement, with exact movement and fee totals, as one row."""
    side = fees.select("tx_hash", "fee_wei", "fee_usd")
    return per_tx.join(side, "tx_hash", "left").agg(
        F.count("*").alias("transactions"),
        F.count_if(F.col("movement_raw") > 0).alias("positive_movement_transactions"),
        F.count_if(F.col("movement_raw") == 0).alias("zero_movement_transactions"),
        F.count_if(F.col("fee_wei").isNull()).alias("transactions_without_fee"),
        whole(F.sum("movement_raw")).alias("movement_raw"),
        whole(F.sum("fee_wei")).alias("fee_wei"),
        F.round(F.sum("fee_usd"), 6).cast("decimal(38,6)").alias("fee_usd"),
    )


def daily_groups(groups: DataFrame) -> DataFrame:
    return groups.groupBy(*PAIR, "block_date").agg(F.count("*").alias("day_groups"))


def qualify_pairs(groups: DataFrame, min_groups: int, min_days: int) -> DataFrame:
    """Address-token pairs with enough nonzero groups on enough dates.

    Counting per day first keeps a busy pair's rows apart until they are few.
    """
    pairs = daily_groups(groups).groupBy(*PAIR).agg(
        F.sum("day_groups").alias("group_count"), F.count("*").alias("active_days")
    )
    return pairs.where((F.col("group_count") >= min_groups) & (F.col("active_days") >= min_days))


def actor_rollup(pairs: DataFrame, flags: Sequence[str] = ()) -> DataFrame:
    """Any qualifying pair makes an actor; a flag on any pair is the actor's flag."""
    return pairs.groupBy("address").agg(
        F.count("*").alias("qualified_pairs"),
        F.sum("group_count").alias("group_count"),
        *[F.bool_or(f).alias(f) for f in flags],
    )


def daily_concentration(groups: DataFrame) -> DataFrame:
    """Busiest day's share and the Herfindahl index over active days, in basis points.

    The index is 10,000 times the sum of squared day shares, rounded down.
    """
    n = whole(F.col("day_groups"))
    total = whole(F.col("_n"))
    return (
        daily_groups(groups)
        .groupBy(*PAIR)
        .agg(
            F.sum("day_groups").alias("_n"),
            F.max("day_groups").alias("_m"),
            F.sum((n * n).cast(RAW)).alias("_sq"),
        )
        .select(
            *PAIR,
            bps(F.col("_m"), F.col("_n")).alias("max_day_share_bps"),
            bps(F.col("_sq"), total * total).alias("hhi_bps"),
        )
    )


def counterparty_features(transfers: DataFrame, pairs: DataFrame | None = None) -> DataFrame:
    """Distinct direct counterparties and the top one's share of transaction participations.

    With ``pairs`` only their legs are counted, and the others go before the first shuffle of legs
    by counterparty.
    """
    legs = transfer_legs(transfers).select(*PAIR, "counterparty", "tx_hash")
    if pairs is not None:
        legs = legs.join(pairs.select(*PAIR), PAIR, "left_semi")
    seen = legs.distinct()
    per_counterparty = seen.groupBy(*PAIR, "counterparty").agg(F.count("*").alias("n"))
    return (
        per_counterparty.groupBy(*PAIR)
        .agg(
            F.count("*").alias("counterparties"),
            F.sum("n").alias("participations"),
            F.max("n").alias("_top"),
        )
        .select(
            *PAIR,
            "counterparties",
            "participations",
            bps(F.col("_top"), F.col("participations")).alias("top_share_bps"),
        )
    )


def group_gaps(groups: DataFrame, segment: Column) -> DataFrame:
    """Whole seconds between a pair's consecutive groups, one row per gap."""
    at = F.unix_seconds(F.col("block_time").cast("timestamp"))
    rows = groups.select(*PAIR, *TX_ORDER, at.alias("_at"))
    with_previous = carry(
        rows, PAIR, segment, TX_ORDER, Carry("_at", "_prev", include_current=False)
    )
    return with_previous.where(F.col("_prev").isNotNull()).select(
        *PAIR, (F.col("_at") - F.col("_prev")).alias("gap")
    )


def interval_features(gaps: DataFrame) -> DataFrame:
    """Median, variation, quartile spread and zero share of a pair's gaps.

    Population deviation, linear percentiles, whole basis points rounded down. A quartile lies at a
    rank that is a multiple of a quarter, so it is an exact integer of quarters of its two
    neighbours. Equal gaps are counted; the counts are summed up in segments of the gaps' range, and
    the rows that cover a wanted rank are picked by an aggregate, so no pair's gaps ever meet in one
    place.
    """
    counted = gaps.groupBy(*PAIR, "gap").agg(F.count("*").alias("c"))
    ranked = running_total(counted, PAIR, magnitude(F.col("gap")), ["gap"], F.col("c"), "upto", "total")
    gap, c = whole(F.col("gap")), whole(F.col("c"))

    def at_rank(rank: Column) -> Column:
        covers = (rank >= F.col("upto") - F.col("c")) & (rank < F.col("upto"))
        return F.max(F.when(covers, F.col("gap")))

    picked = []
    for k in (1, 2, 3):
        low = F.expr(f"(total - 1) * {k} div 4")
        picked += [at_rank(low).alias(f"low{k}"), at_rank(F.least(low + 1, F.col("total") - 1)).alias(f"high{k}")]
    stats = ranked.groupBy(*PAIR).agg(
        F.sum("c").alias("gap_count"),
        F.sum((gap * c).cast(RAW)).alias("s"),
        F.sum(((gap * gap).cast(RAW) * c).cast(RAW)).alias("q"),
        F.coalesce(F.sum(F.when(F.col("gap") == 0, F.col("c"))), F.lit(0)).alias("zeros"),
        *picked,
    )
    quarters = []
    for k in (1, 2, 3):
        rest = (F.col("gap_count") - 1) * k % 4
        quarters.append(F.col(f"low{k}") * (F.lit(4) - rest) + F.col(f"high{k}") * rest)
    n, s, q = whole(F.col("gap_count")), whole(F.col("s")), whole(F.col("q"))
    spread = whole(whole(n * q) - whole(s * s)).cast("double") / whole(s * s).cast("double")
    cv = F.floor(F.sqrt(spread) * 10000).cast("bigint")
    return stats.select(
        *PAIR,
        "gap_count",
        quarters[1].cast("bigint").alias("median_quarter_seconds"),
        F.when(s > 0, cv).alias("cv_bps"),
        bps(quarters[2] - quarters[0], quarters[1]).alias("iqr_median_bps"),
        bps(F.col("zeros"), n).alias("zero_gap_share_bps"),
    )


def first_activity(groups: DataFrame, actors: DataFrame) -> DataFrame:
    """Each actor's first group in the total order."""
    own = groups.join(actors.select("address"), "address", "left_semi")
    first = first_per_key(own, ["address"], [*TX_ORDER, "token"])
    return first.select(
        "address",
        "token",
        *[F.col(c).alias(f"first_{c}") for c in TX_ORDER],
        F.col("block_time").alias("first_time"),
    )


def actor_tx_net(transfers: DataFrame, actors: DataFrame | None = None) -> DataFrame:
    """Combined net of an address per transaction over all tokens, with its direct sources.

    With ``actors`` only their legs are netted.
    Only the smallest and largest sender are kept: they are equal exactly when one source paid.
    """
    source = F.when(F.col("incoming") > 0, F.col("counterparty"))
    legs = transfer_legs(transfers)
    if actors is not None:
        legs = legs.join(actors.select("address"), "address", "left_semi")
    return (
        legs.withColumn("_source", source)
        .groupBy("address", "tx_hash")
        .agg(
            whole(F.sum("incoming") - F.sum("outgoing")).alias("net_raw"),
            F.min("_source").alias("source_low"),
            F.max("_source").alias("source_high"),
            *[F.min(c).alias(c) for c in TX],
        )
    )


def lookback_range_join(
    nets: DataFrame, first: DataFrame, lookback: timedelta = timedelta(days=30)
) -> DataFrame:
    """An actor's transactions in the window before its own first activity.

    One row per actor meets many transactions, so equality on the actor bounds the result by
    the number of transactions; a busy actor is split by AQE.
    """
    at = F.struct(*TX_ORDER)
    before = F.struct(*[F.col(f"first_{c}") for c in TX_ORDER])
    since = F.col("first_time") - F.lit(lookback)
    return nets.join(first.drop("token"), "address").where(
        (at < before) & (F.col("block_time") >= since)
    )


def first_funding_tx(lookback: DataFrame) -> DataFrame:
    """Earliest transaction with a positive combined net inflow."""
    return first_per_key(lookback.where(F.col("net_raw") > 0), ["address"], TX_ORDER)


def funding_proxy(funding: DataFrame, transactions: DataFrame) -> DataFrame:
    """First funding with its source, its raw transaction and whether a proxy may be taken.

    A proxy needs one direct source, one raw transaction row and an outer sender that is not
    the actor.
    """
    asked = funding.select("tx_hash").distinct()
    raw = transactions.join(asked, "tx_hash", "left_semi").groupBy("tx_hash").agg(
        F.count("*").alias("tx_rows"), F.min("tx_sender").alias("tx_sender")
    )
    rows = funding.join(raw, "tx_hash", "left")
    single = F.coalesce(F.col("source_low") == F.col("source_high"), F.lit(False))
    external = F.coalesce(F.col("tx_sender") != F.col("address"), F.lit(False))
    one_row = F.coalesce(F.col("tx_rows") == 1, F.lit(False))
    return rows.select(
        "address",
        "tx_hash",
        F.col("net_raw").alias("funding_raw"),
        F.date_trunc("hour", "block_time").alias("funding_hour"),
        F.when(single, F.col("source_low")).alias("source"),
        single.alias("single_source"),
        external.alias("external_initiation"),
        (single & external & one_row).alias("is_proxy"),
    )


def reverse_edges(transfers: DataFrame) -> DataFrame:
    """Canonical address pairs of one token with events in both directions.

    Counting both directions of the sorted pair in one aggregate replaces a self join.
    """
    forward = F.col("sender") < F.col("receiver")
    return (
        transfers.groupBy(
            "token",
            F.least("sender", "receiver").alias("low"),
            F.greatest("sender", "receiver").alias("high"),
        )
        .agg(
            F.count_if(forward).alias("forward_events"),
            F.count_if(~forward).alias("reverse_events"),
        )
        .where((F.col("forward_events") > 0) & (F.col("reverse_events") > 0))
        .withColumn("pair_events", F.col("forward_events") + F.col("reverse_events"))
        .withColumn("combinations", F.col("forward_events") * F.col("reverse_events"))
    )


def exact_unit_convert(groups: DataFrame, by: Sequence[str], value: str, out: str) -> DataFrame:
    """Integer totals per group; conversion to units happens once, afterwards."""
    return groups.groupBy(*by).agg(whole(F.sum(whole(F.col(value)))).alias(out))
