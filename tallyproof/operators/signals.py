"""Signal families, their fusion and the reports built on them.

A signal is screening evidence and says nothing about intent or ownership.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyproof.functions.decimals import bps, int_div, percent, reaches
from tallyproof.operators.ordered import first_n_per_key, magnitude, running_total
from tallyproof.operators.reconcile import beside

# Thresholds of the four families, in basis points unless named otherwise.
MAX_CV = 7000
MAX_IQR_MEDIAN = 6000
MIN_ZERO_GAP = 2000
MIN_DAY_SHARE = 8000
MIN_HHI = 6500
MAX_COUNTERPARTIES = 2
MIN_TOP_SHARE = 9500
MIN_CLUSTER = 10
MIN_AMOUNT_SHARE = 8000
MIN_HOUR_SHARE = 5000
ECONOMIC_GATE = 5000

# Class names by number of families.
ORGANIC = "organic candidate"
AMBIGUOUS = "ambiguous"
INORGANIC = "likely inorganic"
FAMILIES = ["temporal", "richness", "funding", "economic"]


def _true(cond: Column) -> Column:
    return F.coalesce(cond, F.lit(False))


def temporal_pairs(intervals: DataFrame, concentration: DataFrame) -> DataFrame:
    """The three temporal branches per qualified pair; a pair without gaps can only burst."""
    rows = concentration.join(intervals, ["address", "token"], "left")
    regular = (
        (F.col("median_quarter_seconds") > 0)
        & (F.col("cv_bps") <= MAX_CV)
        & (F.col("iqr_median_bps") <= MAX_IQR_MEDIAN)
    )
    burst = F.col("zero_gap_share_bps") >= MIN_ZERO_GAP
    single = (F.col("max_day_share_bps") >= MIN_DAY_SHARE) & (F.col("hhi_bps") >= MIN_HHI)
    return rows.select(
        "address",
        "token",
        _true(regular).alias("clock_like"),
        _true(burst).alias("same_second_burst"),
        _true(single).alias("single_day_burst"),
        F.coalesce("zero_gap_share_bps", F.lit(0)).alias("zero_gap_share_bps"),
    )


def temporal_family(pairs: DataFrame) -> DataFrame:
    """Any branch on any pair gives the actor one family; branches may overlap."""
    branches = ["clock_like", "same_second_burst", "single_day_burst"]
    any_branch = reduce(lambda a, b: a | b, [F.bool_or(b) for b in branches])
    return pairs.groupBy("address").agg(
        *[F.bool_or(b).alias(b) for b in branches],
        any_branch.alias("temporal"),
        F.max("zero_gap_share_bps").alias("zero_gap_share_bps"),
    )


def richness_family(features: DataFrame) -> DataFrame:
    """Fires on low breadth: few counterparties and one that dominates, on any pair."""
    hit = (F.col("counterparties") <= MAX_COUNTERPARTIES) & (
        F.col("top_share_bps") >= MIN_TOP_SHARE
    )
    return features.groupBy("address").agg(F.bool_or(hit).alias("richness"))


def source_clusters(proxies: DataFrame) -> DataFrame:
    """Per funding source: size, largest equal-amount share and largest same-hour share.

    Each share counts values before it takes the largest, so a source with very many actors is
    summed in parts.
    """
    def largest(column: str, out: str) -> DataFrame:
        per_value = proxies.groupBy("source", column).agg(F.count("*").alias("n"))
        return per_value.groupBy("source").agg(
            F.sum("n").alias(f"{out}_size"), F.max("n").alias(out)
        )

    amounts = largest("funding_raw", "top_amount")
    hours = largest("funding_hour", "top_hour")
    return amounts.join(hours, "source").select(
        "source",
        F.col("top_amount_size").alias("cluster_size"),
        bps(F.col("top_amount"), F.col("top_amount_size")).alias("amount_share_bps"),
        bps(F.col("top_hour"), F.col("top_hour_size")).alias("hour_share_bps"),
    )


def cluster_flags(clusters: DataFrame, min_size: int = MIN_CLUSTER) -> DataFrame:
    """Candidate: large and concentrated by amount or hour; strong: by both."""
    large = F.col("cluster_size") >= min_size
    amount = F.col("amount_share_bps") >= MIN_AMOUNT_SHARE
    hour = F.col("hour_share_bps") >= MIN_HOUR_SHARE
    return clusters.withColumn("is_candidate", large & (amount | hour)).withColumn(
        "is_strong", large & amount & hour
    )


def funding_family(proxies: DataFrame, flags: DataFrame) -> DataFrame:
    """Actors of candidate clusters; strong is a subset and adds no second count."""
    sources = flags.where("is_candidate").select("source", "is_strong")
    return proxies.join(sources, "source").select(
        "address", F.lit(True).alias("funding"), F.col("is_strong").alias("strong_funding")
    )


def funding_status_ledger(actors: DataFrame, proxies: DataFrame) -> DataFrame:
    """How far each actor's funding could be followed. ``proxies`` carries ``is_listed``."""
    side = proxies.select(
        "address", "source", "single_source", "external_initiation", "is_proxy", "is_listed",
        F.lit(True).alias("_seen"),
    )
    rows = actors.select("address").join(side, "address", "left")
    seen, proxy = _true(F.col("_seen")), _true(F.col("is_proxy"))
    open_source = proxy & ~_true(F.col("is_listed"))
    counts = rows.agg(
        F.count("*").alias("actors"),
        F.count_if(seen).alias("observed_inflow_actors"),
        F.count_if(~seen).alias("censored_actors"),
        F.count_if(_true(F.col("single_source"))).alias("single_source_actors"),
        F.count_if(seen & ~_true(F.col("single_source"))).alias("multi_source_actors"),
        F.count_if(_true(F.col("external_initiation"))).alias("external_initiation_actors"),
        F.count_if(proxy).alias("proxy_actors"),
        F.count_if(proxy & _true(F.col("is_listed"))).alias("listed_source_actors"),
        F.count_if(open_source).alias("unlisted_source_actors"),
    )
    sources = (
        rows.where(open_source)
        .select("source")
        .distinct()
        .agg(F.count("*").alias("distinct_unlisted_sources"))
    )
    return beside(counts, sources)


def funding_coverage_matrix(proxies: DataFrame, clusters: DataFrame) -> DataFrame:
    """Sources and actors by band of size, amount share and hour share.

    The public text names only the matrix; the bands are 5/10/20/50 and 5000/8000/9500 bps.
    """
    def band(column: str, edges: Sequence[int]) -> Column:
        out = F.lit(0)
        for edge in edges:
            out = F.when(F.col(column) >= edge, F.lit(edge)).otherwise(out)
        return out.cast("int")

    return (
        clusters.withColumn("size_band", band("cluster_size", (5, 10, 20, 50)))
        .withColumn("amount_band", band("amount_share_bps", (5000, 8000, 9500)))
        .withColumn("hour_band", band("hour_share_bps", (5000, 8000, 9500)))
        .groupBy("size_band", "amount_band", "hour_band")
        .agg(F.count("*").alias("sources"), F.sum("cluster_size").alias("actors"))
    )


def economic_actor_share(groups: DataFrame) -> DataFrame:
    """Fired and nonzero groups per actor. ``groups`` carries the boolean ``fired``."""
    return groups.groupBy("address").agg(
        F.count("*").alias("nonzero_groups"), F.count_if("fired").alias("fired_groups")
    )


def economic_family(shares: DataFrame, gate_bps: int = ECONOMIC_GATE) -> DataFrame:
    """The fee reaches the movement in at least the gate's share of groups."""
    hit = (F.col("fired_groups") > 0) & reaches(
        F.col("fired_groups"), F.col("nonzero_groups"), gate_bps
    )
    return shares.withColumn("economic", hit).withColumn(
        "economic_share_bps", bps(F.col("fired_groups"), F.col("nonzero_groups"))
    )


def class_of(families: Column) -> Column:
    """Class by number of families; a missing count has no class."""
    return F.when(families == 0, ORGANIC).when(families == 1, AMBIGUOUS).when(families > 1, INORGANIC)


def fuse_families(
    actors: DataFrame, families: dict[str, DataFrame], keep: Sequence[str] = ()
) -> DataFrame:
    """Add up the family flags per actor; an actor missing from a family did not fire."""
    out = actors
    for name, df in families.items():
        extra = [c for c in keep if c in df.columns and c not in out.columns]
        out = out.join(df.select("address", name, *extra), "address", "left")
        out = out.withColumn(name, F.coalesce(name, F.lit(False)))
    total = reduce(lambda a, b: a + b, [F.col(n).cast("int") for n in families])
    return out.withColumn("families", total).withColumn("actor_class", class_of(F.col("families")))


def class_partition(fused: DataFrame, actors: DataFrame) -> DataFrame:
    """Actors and share per class; the residual is the number of qualified ``actors``, counted
    before the families were joined, less the actors in one of the three classes."""
    classes = [ORGANIC, AMBIGUOUS, INORGANIC]
    counts = fused.groupBy("actor_class").agg(F.count("*").alias("actors"))
    across = Window.partitionBy()
    total = F.sum("actors").over(across)
    known = F.sum(F.when(F.col("actor_class").isin(classes), F.col("actors"))).over(across)
    counts = counts.withColumn("_known", known).withColumn("_total", total)
    qualified = actors.select("address").distinct().agg(F.count("*").alias("_qualified"))
    return beside(counts, qualified).select(
        "actor_class",
        "actors",
        percent(F.col("actors"), F.col("_total"), 6).alias("share_pct"),
        (F.col("_qualified") - F.coalesce("_known", F.lit(0))).alias("partition_residual"),
    )


def strict_inclusive_bounds(fused: DataFrame) -> DataFrame:
    """Strict and inclusive counts of both sides; the bounds are no confidence interval."""
    klass = F.col("actor_class")
    return fused.agg(
        F.count("*").alias("actors"),
        F.count_if(klass == ORGANIC).alias("strict_organic"),
        F.count_if(klass.isin(ORGANIC, AMBIGUOUS)).alias("inclusive_organic"),
        F.count_if(klass == INORGANIC).alias("strict_inorganic"),
        F.count_if(klass.isin(INORGANIC, AMBIGUOUS)).alias("inclusive_inorganic"),
    )


def threshold_grid(fused: DataFrame, gates: dict[str, int]) -> DataFrame:
    """Fusion under several economic gates in one pass; gate 0 means any fired group.

    ``fused`` holds the other families and the fired and nonzero group counts.
    """
    others = [f for f in FAMILIES if f != "economic" and f in fused.columns]
    base = reduce(lambda a, b: a + b, [F.col(f).cast("int") for f in others])
    cells = F.array(
        *[F.struct(F.lit(n).alias("gate"), F.lit(g).alias("gate_bps")) for n, g in gates.items()]
    )
    fired = F.coalesce("fired_groups", F.lit(0))
    total = F.coalesce("nonzero_groups", F.lit(0))
    rows = fused.select(
        base.alias("_base"), fired.alias("_f"), total.alias("_t"), F.explode(cells).alias("g")
    )
    hit = (F.col("_f") > 0) & reaches(F.col("_f"), F.col("_t"), F.col("g.gate_bps"))
    families = F.col("_base") + hit.cast("int")
    return (
        rows.withColumn("hit", hit)
        .withColumn("families", families)
        .groupBy(F.col("g.gate").alias("gate"))
        .agg(
            F.count("*").alias("actors"),
            F.count_if("hit").alias("economic_actors"),
            F.count_if(F.col("families") == 0).alias("organic_candidates"),
            F.count_if(F.col("families") == 1).alias("ambiguous_actors"),
            F.count_if(F.col("families") >= 2).alias("likely_inorganic"),
        )
    )


def window_comparison(rows: DataFrame, tag: str, main: str, other: str) -> DataFrame:
    """Class counts of two windows and the difference of the inorganic shares."""
    share = percent(F.col("likely_inorganic"), F.col("actors"), 6)
    per = (
        rows.groupBy(tag)
        .agg(
            F.count("*").alias("actors"),
            *[F.count_if(f).alias(f"{f}_actors") for f in ("temporal", "richness", "economic")],
            F.count_if(F.col("families") == 0).alias("organic_candidates"),
            F.count_if(F.col("families") == 1).alias("ambiguous_actors"),
            F.count_if(F.col("families") >= 2).alias("likely_inorganic"),
        )
        .withColumn("share_pct", share)
    )
    across = Window.partitionBy()

    def of(name: str) -> Column:
        return F.max(F.when(F.col(tag) == name, F.col("share_pct"))).over(across)

    points = (of(main) - of(other)).cast("decimal(38,6)")
    relative = percent(F.col("share_difference_points"), F.col("_base"), 4, 6)
    rows = per.withColumn("share_difference_points", points).withColumn("_base", of(other))
    return rows.withColumn("relative_difference_pct", relative).drop("_base")


def stratified_cases(fused: DataFrame, per_stratum: int = 10) -> DataFrame:
    """Deterministic cases: three strata nearest the economic gate and one of extremes.

    Extremes rank by families, economic share, zero-gap share and groups; the address settles
    every tie. Spark keeps at most ``per_stratum`` rows per stratum and map task.
    """
    families = F.col("families")
    stratum = (
        F.when(families == 0, "organic_boundary")
        .when(families == 1, "ambiguous_boundary")
        .when(families == 2, "inorganic_boundary")
        .otherwise("high_cooccurrence")
    )
    share = F.coalesce("economic_share_bps", F.lit(0))
    extreme = families >= 3
    near = F.when(~extreme, F.abs(share - F.lit(ECONOMIC_GATE)))
    zero_gap = F.coalesce("zero_gap_share_bps", F.lit(0))

    def if_extreme(column: Column) -> Column:
        return F.when(extreme, column)

    order = [
        near.asc(),
        if_extreme(families).desc(),
        if_extreme(share).desc(),
        if_extreme(zero_gap).desc(),
        if_extreme(F.col("group_count")).desc(),
        F.col("address").asc(),
    ]
    rows = fused.withColumn("stratum", stratum)
    return first_n_per_key(rows, ["stratum"], order, per_stratum, "case_number")


def distribution_profile(df: DataFrame, value: str, by: Sequence[str]) -> DataFrame:
    """Exact p01..p99 of a non-negative integer per group, with count, minimum and maximum.

    The public text names only the profile; a percentile is the smallest value that at least
    that share of rows does not exceed. Equal values are counted first and the counts are summed
    up in segments of the value range, so no group is sorted in one task.
    """
    n = F.col("_n")
    counted = df.groupBy(*by, F.col(value).cast("bigint").alias("_v")).agg(F.count("*").alias("_n"))
    summed = running_total(counted, by, magnitude(F.col("_v")), ["_v"], n, "_upto", "_total")
    total = F.col("_total")
    first = int_div((F.col("_upto") - n) * 100, total).cast("int") + 1
    last = F.least(int_div(F.col("_upto") * 100, total).cast("int"), F.lit(99))
    hit = summed.where(last >= first).withColumn("percentile", F.explode(F.sequence(first, last)))
    edges = counted.groupBy(*by).agg(
        F.min("_v").alias("min_value"), F.max("_v").alias("max_value"),
    )
    return hit.join(edges, list(by)).select(
        *by,
        "percentile",
        F.col("_v").alias("percentile_value"),
        F.col("_total").alias("value_count"),
        "min_value",
        "max_value",
    )


def approximate_profile(df: DataFrame, value: str, by: Sequence[str]) -> DataFrame:
    """The same grid with bounded memory and a relative rank error of 1e-4."""
    grid = F.array(*[F.lit(i / 100) for i in range(1, 100)])
    values = df.groupBy(*by).agg(
        F.percentile_approx(F.col(value).cast("bigint"), grid, 10000).alias("_p"),
        F.count("*").alias("value_count"),
    )
    return values.select(
        *by, F.posexplode("_p").alias("_i", "percentile_value"), "value_count"
    ).select(*by, (F.col("_i") + 1).alias("percentile"), "percentile_value", "value_count")

