"""Four-signal activity screening over netted transfers."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyproof.functions.decimals import exact_decimals
from tallyproof.functions.formulas import fee_reaches_movement, fee_to_movement_bps, fee_wei
from tallyproof.operators.enrich import annotation_split, priced_fees
from tallyproof.operators.reconcile import paired
from tallyproof.operators.signals import (
    cluster_flags,
    economic_actor_share,
    economic_family,
    funding_family,
    fuse_families,
    richness_family,
    source_clusters,
    temporal_family,
    temporal_pairs,
)
from tallyproof.operators.transfers import (
    PAIR,
    actor_rollup,
    actor_tx_net,
    address_netting,
    counterparty_features,
    daily_concentration,
    first_activity,
    first_funding_tx,
    funding_proxy,
    group_gaps,
    interval_features,
    lookback_range_join,
    nonzero_groups,
    qualify_pairs,
    tx_movement,
    tx_token_movement,
)
from tallyproof.plans.evidence import case_evidence
from tallyproof.sources.scans import in_window, prices_of_window
from tallyproof.sources.tables import frozen_relation


@dataclass(frozen=True)
class Rules:
    """Gates of one screening run; the defaults are the published ones."""

    start: datetime
    end: datetime
    min_groups: int = 10
    min_days: int = 4
    min_cluster: int = 10
    gate_bps: int = 5000
    lookback: timedelta = timedelta(days=30)
    gas_asset: str = "GAS"


@dataclass(frozen=True)
class Inputs:
    """Input relations. ``segment`` cuts the activity order of a busy address."""

    transfers: DataFrame
    transactions: DataFrame
    gas_prices: DataFrame
    listed: DataFrame
    segment: Column


def tx_fees(transactions: DataFrame, prices: DataFrame, asset: object) -> DataFrame:
    """Execution fee of each transaction in wei and USD."""
    rows = transactions.withColumn("fee_wei", fee_wei(F.col("gas_used"), F.col("gas_price")))
    return priced_fees(rows, prices, asset)


def tx_signals(per_tx: DataFrame, fees: DataFrame) -> DataFrame:
    """Fee against combined movement per transaction; an unpriced fee does not fire."""
    rows = per_tx.join(fees.select("tx_hash", "fee_wei", "fee_usd", "gas_asset_price"), "tx_hash",
                       "left")
    wei, price, moved = F.col("fee_wei"), F.col("gas_asset_price"), F.col("movement_raw")
    with exact_decimals(per_tx.sparkSession):
        return rows.withColumn(
            "fee_to_movement_bps", fee_to_movement_bps(wei, price, moved)
        ).withColumn("fired", F.coalesce(fee_reaches_movement(wei, price, moved), F.lit(False)))


@dataclass(frozen=True)
class Stages:
    """Stage results that several signals share."""

    window: DataFrame
    netting: DataFrame
    groups: DataFrame
    pairs: DataFrame
    own_groups: DataFrame
    signals: DataFrame


def build_stages(inputs: Inputs, rules: Rules, freeze: bool = True) -> Stages:
    """Net, qualify and price one window.

    With ``freeze`` the netted and the qualified groups are stored once and read back by every
    signal; without it each signal rebuilds them, which suits a query that needs only one.
    """
    window = inputs.transfers.where(
        in_window(inputs.transfers, "block_time", rules.start, rules.end)
    )
    netting = address_netting(window)
    if freeze:
        netting = frozen_relation(netting, "netting")
    groups = nonzero_groups(netting)
    pairs = qualify_pairs(groups, rules.min_groups, rules.min_days)
    own_groups = groups.join(pairs.select(*PAIR), PAIR, "left_semi")
    if freeze:
        own_groups = frozen_relation(own_groups, "qualified-groups")
    mined = inputs.transactions.where(
        in_window(inputs.transactions, "block_time", rules.start, rules.end)
    )
    quoted = prices_of_window(inputs.gas_prices, rules.start, rules.end, "hour")
    fees = tx_fees(mined, quoted, rules.gas_asset)
    signals = tx_signals(tx_movement(tx_token_movement(netting)), fees)
    return Stages(window, netting, groups, pairs, own_groups, signals)


def temporal(stages: Stages, segment: Column) -> DataFrame:
    gaps = interval_features(group_gaps(stages.own_groups, segment))
    return temporal_pairs(gaps, daily_concentration(stages.own_groups))


def richness(stages: Stages) -> DataFrame:
    return counterparty_features(stages.window, stages.pairs)


def economic(stages: Stages, gate_bps: int) -> DataFrame:
    fired = stages.own_groups.select("address", "tx_hash").join(
        stages.signals.select("tx_hash", "fired"), "tx_hash", "left"
    )
    fired = fired.withColumn("fired", F.coalesce("fired", F.lit(False)))
    return economic_family(economic_actor_share(fired), gate_bps)


def actor_lookback(inputs: Inputs, rules: Rules, stages: Stages) -> DataFrame:
    """Transactions of each actor in its own lookback."""
    since = rules.start - rules.lookback
    history = inputs.transfers.where(in_window(inputs.transfers, "block_time", since, rules.end))
    actors = actor_rollup(stages.pairs)
    first = first_activity(stages.groups, actors)
    return lookback_range_join(actor_tx_net(history, actors), first, rules.lookback)


def funding(inputs: Inputs, rules: Rules, stages: Stages) -> DataFrame:
    """Funding status of every actor with an observed inflow, split by the exchange list.

    The first fundings, one row per actor, are stored: the lookback behind them is read by the
    proxies and by the clusters of their sources.
    """
    found = frozen_relation(first_funding_tx(actor_lookback(inputs, rules, stages)), "funding")
    since = rules.start - rules.lookback
    mined = inputs.transactions.where(
        in_window(inputs.transactions, "block_time", since, rules.end)
    )
    proxies = funding_proxy(found, mined)
    return annotation_split(proxies, inputs.listed, "source", "address")


def open_proxies(status: DataFrame) -> DataFrame:
    """Proxies whose source is on no exchange list."""
    return status.where(F.col("is_proxy") & ~F.col("is_listed"))


def activity_screen(
    inputs: Inputs, rules: Rules, stages: Stages | None = None, with_funding: bool = True
) -> DataFrame:
    """Actors of one window with family flags, evidence and class.

    Without funding this is the lightweight form used to compare adjacent windows.
    """
    stages = stages or build_stages(inputs, rules)
    families = {
        "temporal": temporal_family(temporal(stages, inputs.segment)),
        "richness": richness_family(richness(stages)),
        "economic": economic(stages, rules.gate_bps),
    }
    if with_funding:
        proxies = open_proxies(funding(inputs, rules, stages))
        flags = cluster_flags(source_clusters(proxies), rules.min_cluster)
        families["funding"] = funding_family(proxies, flags)
    kept = [
        "clock_like", "same_second_burst", "single_day_burst", "zero_gap_share_bps",
        "nonzero_groups", "fired_groups", "economic_share_bps", "strong_funding",
    ]
    return fuse_families(actor_rollup(stages.pairs), families, kept)


def adjacent_windows(inputs: Inputs, windows: dict[str, Rules]) -> DataFrame:
    """The lightweight pipeline on several windows, told apart by ``window_name``."""
    out = None
    for name, rules in windows.items():
        rows = activity_screen(inputs, rules, build_stages(inputs, rules), with_funding=False)
        part = rows.select(F.lit(name).alias("window_name"), "*")
        out = part if out is None else out.unionByName(part)
    return out


# Evidence of a case that is rebuilt from raw rows.
EVIDENCE = ["temporal", "richness", "economic", "nonzero_groups", "fired_groups"]


def case_recompute(cases: DataFrame, inputs: Inputs, rules: Rules) -> DataFrame:
    """Rebuild the temporal, counterparty and economic evidence of selected cases and compare.

    The second way (``plans/evidence.py``) starts from the raw rows of transactions that touch a case
    and shares no operator with the screen, so a fault on either side shows. Returns stored and
    rebuilt evidence per case with a pass flag.
    """
    chosen = cases.select("address", "stratum", *EVIDENCE)
    again = case_evidence(
        chosen, inputs.transfers, inputs.transactions, inputs.gas_prices, (rules.start, rules.end),
        rules.gate_bps, rules.min_groups, rules.min_days, rules.gas_asset,
    )
    both = paired(chosen, again, ["address"], EVIDENCE)
    sides = {"stored": F.col("l"), "rebuilt": F.col("r")}
    return both.join(chosen.select("address", "stratum"), "address").select(
        "address",
        "stratum",
        *[side[e].alias(f"{name}_{e}") for e in EVIDENCE for name, side in sides.items()],
        F.col("l").eqNullSafe(F.col("r")).alias("case_passes"),
    )
