"""Windowed scans of fact tables, curated legs, schema contracts and source inventories."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime, time, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyproof.functions.decimals import six_dp, usd


def _same(dims: Mapping[str, object]) -> Column:
    cond = F.lit(True)
    for name, value in dims.items():
        cond = cond & (F.col(name) == F.lit(value))
    return cond


def _bound(df: DataFrame, column: str, at: datetime) -> Column:
    """A literal of the column's own timestamp type, so the comparison reaches the scan."""
    return F.lit(at).cast(df.schema[column].dataType)


def in_window(df: DataFrame, ts: str, start: datetime, end: datetime) -> Column:
    """Half-open UTC window."""
    return (F.col(ts) >= _bound(df, ts, start)) & (F.col(ts) < _bound(df, ts, end))


def window_scan(
    df: DataFrame,
    dims: Mapping[str, object],
    ts: str,
    start: datetime,
    end: datetime,
    columns: Mapping[str, str] | None = None,
) -> DataFrame:
    """Rows of one scope and window; ``columns`` maps source names to output names."""
    rows = df.where(_same(dims) & in_window(df, ts, start, end))
    if columns is None:
        return rows
    return rows.select(*[F.col(src).alias(name) for src, name in columns.items()])


def prices_of_window(
    prices: DataFrame, start: datetime, end: datetime, grain: str = "minute", ts: str = "bucket"
) -> DataFrame:
    """Price rows whose bucket can hold an event of the half-open window, as a scan filter."""
    cut = {"month": {"day": 1, "hour": 0}, "day": {"hour": 0}, "hour": {}, "minute": {}}[grain]
    first = start.replace(**cut, second=0, microsecond=0, **({} if grain == "minute" else {"minute": 0}))
    return prices.where(in_window(prices, ts, first, end))


def dates_of_window(start: datetime, end: datetime) -> tuple[date, date]:
    """Smallest half-open date range that covers a half-open time window."""
    last = end.date() if end.time() == time() else end.date() + timedelta(days=1)
    return start.date(), last


def months_of_window(start: datetime, end: datetime) -> tuple[date, date]:
    """Smallest half-open range of month starts that covers a half-open time window."""
    last = (end - timedelta(microseconds=1)).date().replace(day=1)
    following = (last + timedelta(days=32)).replace(day=1)
    return start.date().replace(day=1), following


def partition_pruned_scan(
    df: DataFrame,
    dims: Mapping[str, object],
    ts: str,
    start: datetime,
    end: datetime,
    columns: Mapping[str, str] | None = None,
    partition: str = "block_date",
) -> DataFrame:
    """``window_scan`` that also bounds the partition date, so whole files are skipped."""
    first, last = dates_of_window(start, end)
    pruned = df.where((F.col(partition) >= F.lit(first)) & (F.col(partition) < F.lit(last)))
    return window_scan(pruned, dims, ts, start, end, columns)


def leg_scan(
    df: DataFrame,
    dims: Mapping[str, object],
    transaction_type: str,
    start: datetime,
    end: datetime,
    columns: Sequence[str],
    ts: str = "block_time",
) -> DataFrame:
    """One curated leg of one transaction type, month-pruned, with a widened event index."""
    first, last = months_of_window(start, end)
    pruned = df.where((F.col("block_month") >= F.lit(first)) & (F.col("block_month") < F.lit(last)))
    rows = window_scan(pruned, {**dims, "transaction_type": transaction_type}, ts, start, end)
    return rows.withColumn("evt_index", F.col("evt_index").cast("bigint")).select(*columns)


def schema_rows(df: DataFrame) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in df.schema.fields]


def schema_contract(df: DataFrame, expected: T.StructType | Mapping[str, str]) -> DataFrame:
    """One row per expected or live column with its types, status and number of values.

    The values are counted in one scan, since a column that exists but is empty breaks a model
    just as a missing one does.
    """
    if isinstance(expected, T.StructType):
        expected = {f.name: f.dataType.simpleString() for f in expected.fields}
    spark = df.sparkSession
    want = spark.createDataFrame(list(expected.items()), "column_name string, expected_type string")
    cells = F.array(
        *[
            F.struct(F.lit(n).alias("column_name"), F.lit(t).alias("live_type"), F.col(n).alias("v"))
            for n, t in schema_rows(df)
        ]
    )
    counted = df.agg(*[F.count(n).alias(n) for n, _ in schema_rows(df)])
    live = counted.select(F.explode(cells).alias("c")).select(
        "c.column_name", "c.live_type", F.col("c.v").alias("value_rows")
    )
    status = (
        F.when(F.col("live_type").isNull(), "MISSING")
        .when(F.col("expected_type").isNull(), "EXTRA")
        .when(F.col("live_type") != F.col("expected_type"), "TYPE_CHANGED")
        .otherwise("OK")
    )
    return want.join(live, "column_name", "full_outer").withColumn("status", status)


def source_inventory(sources: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Row count and first and last time of each named source; one scan per source."""
    parts = [
        df.agg(
            F.count("*").alias("row_count"),
            F.min(ts).cast("date").alias("first_date"),
            F.max(ts).cast("date").alias("last_date"),
        ).select(F.lit(name).alias("source"), "*")
        for name, (df, ts) in sources.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def price_coverage_audit(
    computed: DataFrame, curated: DataFrame, keys: Sequence[str], amount: str
) -> DataFrame:
    """Computed against curated amounts of the same keys, per calendar day.

    The public text names only the check and its sources. Reported here: rows on both sides,
    rows without a computed price, rows without a curated twin, and the summed amount gap of
    rows that have both.
    """
    twin = curated.select(*keys, F.col(amount).alias("_curated"), F.lit(1).alias("_seen"))
    both = F.col(amount).isNotNull() & F.col("_curated").isNotNull()
    gap = usd(F.col(amount)) - usd(F.col("_curated"))
    return (
        computed.join(twin, list(keys), "left")
        .groupBy("block_date")
        .agg(
            F.count("*").alias("computed_rows"),
            F.count_if(F.col("_seen").isNotNull()).alias("matched_rows"),
            F.count_if(F.col(amount).isNull()).alias("missing_price_rows"),
            F.count_if(F.col("_seen").isNull()).alias("missing_curated_rows"),
            six_dp(F.coalesce(F.sum(F.when(both, usd(gap))), F.lit(0))).alias("amount_gap_usd"),
        )
    )
