"""Adapters from the driver's test tables to the package's input relations.

The test tables are no chain data; these views keep the shape of the problem. Doubles are cast
to a short decimal first, because both engines agree only on those.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyproof.functions.decimals import RAW, dec, exact_decimals
from tallyproof.functions.formulas import base_transfer_filter
from tallyproof.operators.ordered import first_per_key
from tallyproof.session import use_utc

CHAIN = {"blockchain": "chain_a", "project": "amm"}
LENDER = {"blockchain": "chain_a", "project": "lender", "version": "3"}
EPOCH = "1995-01-01"
FIRST_DAY = datetime(1992, 1, 1)
LAST_DAY = datetime(2030, 1, 1)
TARGET_POOL = 7
ORDER = ["block_number", "evt_index"]
EVENT_KEY = ["tx_hash", "evt_index"]
REPAIR_KEY = ["block_number", "tx_hash", "evt_index", "pool"]
# Days of one segment of a pool's event order.
SEGMENT_DAYS = 64

MAIN = (datetime(2024, 1, 16), datetime(2024, 1, 31))
ADJACENT = (datetime(2024, 1, 1), datetime(2024, 1, 16))
TOKENS = ["A", "B"]
ZERO_ADDRESS = -1


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    use_utc(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def block_of(day: Column) -> Column:
    return F.date_diff(day, F.lit(EPOCH).cast("date")).cast("bigint")


def segment_of(block: Column) -> Column:
    return F.floor(block / SEGMENT_DAYS)


def trades_all(spark: SparkSession, folder: str) -> DataFrame:
    """Undeduplicated trades from line items."""
    return as_trades(table(spark, folder, "lineitem"))


def trades(spark: SparkSession, folder: str) -> DataFrame:
    """One trade per event key; the copies go before anything is derived from them."""
    return as_trades(unique_lines(spark, folder))


def unique_lines(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem")
    return first_per_key(
        lines, ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey", "l_extendedprice"]
    )


def as_trades(lines: DataFrame) -> DataFrame:
    day = F.col("l_shipdate").cast("date")
    token0, token1 = F.col("l_suppkey") * 2, F.col("l_suppkey") * 2 + 1
    flag = F.col("l_returnflag")
    quantity = F.col("l_quantity").cast("decimal(18,6)")
    return lines.select(
        F.lit(CHAIN["blockchain"]).alias("blockchain"),
        F.lit(CHAIN["project"]).alias("project"),
        F.col("l_linestatus").alias("version"),
        day.alias("block_date"),
        F.col("l_shipdate").alias("block_time"),
        block_of(day).alias("block_number"),
        F.col("l_orderkey").alias("tx_hash"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("evt_index"),
        F.col("l_suppkey").alias("pool"),
        F.when(flag == "A", token0).when(flag == "N", token1).alias("token_sold"),
        F.when(flag == "A", token1).when(flag == "N", token0).alias("token_bought"),
        quantity.alias("token_sold_amount"),
        (quantity * (F.col("l_linenumber") + 1)).cast("decimal(18,6)").alias("token_bought_amount"),
        F.when(F.col("l_tax") != 0.08, F.col("l_extendedprice").cast("decimal(18,6)")).alias(
            "amount_usd"
        ),
        F.col("l_extendedprice").cast("decimal(18,6)").alias("list_usd"),
        F.col("l_discount").alias("discount"),
        F.col("l_partkey").alias("part_key"),
    )


def pools(spark: SparkSession, folder: str) -> DataFrame:
    tier = F.element_at(
        F.array(*[F.lit(v) for v in (100, 500, 3000, 10000)]), F.col("s_nationkey") % 4 + 1
    )
    return table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("pool"),
        (F.col("s_suppkey") * 2).alias("token0"),
        (F.col("s_suppkey") * 2 + 1).alias("token1"),
        tier.alias("fee_tier"),
        F.lit(-1).cast("bigint").alias("created_block_number"),
        F.lit(0).cast("bigint").alias("created_evt_index"),
    )


def settings(spark: SparkSession, folder: str) -> DataFrame:
    pool_count = table(spark, folder, "supplier").agg(F.count("*")).scalar()
    key = F.col("o_orderkey")
    return (
        table(spark, folder, "orders")
        .select(
            (F.col("o_custkey") % pool_count).alias("pool"),
            block_of(F.col("o_orderdate").cast("date")).alias("block_number"),
            (key * 8).alias("evt_index"),
            F.when(key % 8 == 0, 0).otherwise(3 + key % 8).cast("int").alias("feeprotocol0"),
            F.when(key % 5 == 0, 0).otherwise(4 + key % 7).cast("int").alias("feeprotocol1"),
        )
    )


def token_prices(trade_rows: DataFrame) -> DataFrame:
    """Daily prices of sold tokens with partial coverage."""
    quoted = trade_rows.where((F.col("discount") >= 0.05) & F.col("token_sold").isNotNull())
    with exact_decimals(trade_rows.sparkSession):
        return quoted.groupBy(
            F.col("token_sold").alias("asset"), F.date_trunc("day", "block_time").alias("bucket")
        ).agg(
            (F.max("list_usd") * dec("0.02", "decimal(4,2)")).cast("decimal(24,8)").alias("price")
        )


def prices(spark: SparkSession, folder: str) -> DataFrame:
    return token_prices(trades(spark, folder))


def asset_of(key: Column) -> Column:
    """28 known assets and one, -1, without metadata."""
    slot = key % 29
    return F.when(slot == 28, F.lit(-1).cast("bigint")).otherwise(slot)


def liquidations_raw(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("o_orderkey")
    cents = (F.col("o_totalprice").cast("decimal(18,2)") * 100).cast(RAW)
    return (
        table(spark, folder, "orders")
        .select(
            F.lit(1).cast("bigint").alias("contract_address"),
            F.col("o_orderdate").alias("evt_block_time"),
            F.col("o_orderdate").cast("date").alias("evt_block_date"),
            block_of(F.col("o_orderdate").cast("date")).alias("evt_block_number"),
            key.alias("evt_tx_hash"),
            (key % 7).alias("evt_index"),
            (F.col("o_custkey") % 11).alias("liquidator"),
            F.col("o_custkey").alias("user"),
            asset_of(key + 5).alias("collateralasset"),
            asset_of(key).alias("debtasset"),
            (cents + key % 1000).cast(RAW).alias("liquidatedcollateralamount"),
            cents.alias("debttocover"),
            (key % 40 == 0).alias("receiveatoken"),
        )
    )


def token_metadata(spark: SparkSession, folder: str) -> DataFrame:
    """Every part as a token, some with an older undated version."""
    part = table(spark, folder, "part")
    key = F.col("p_partkey")
    versions = F.when(key % 10 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    old = F.col("version") == 1
    return part.withColumn("version", F.explode(versions)).select(
        F.lit(CHAIN["blockchain"]).alias("blockchain"),
        key.alias("contract_address"),
        F.when(old, F.concat(F.lit("old "), "p_name")).otherwise(F.col("p_name")).alias("symbol"),
        decimals_of(key).alias("decimals"),
        F.when(~old, F.lit("2024-01-01").cast("date")).alias("_updated_at"),
    )


def decimals_of(key: Column) -> Column:
    return F.when(key % 3 == 0, 2).when(key % 3 == 1, 6).otherwise(8)


def month_prices(spark: SparkSession, folder: str) -> DataFrame:
    """Monthly asset prices of ten places; some are missing and some have undeclared decimals."""
    asset = asset_of(F.col("o_custkey"))
    quoted = table(spark, folder, "orders")
    missing = (F.col("asset") + F.month("bucket")) % 5 == 0
    with exact_decimals(spark):
        fine = F.max(F.col("o_totalprice").cast("decimal(18,2)")) * dec("0.01234567", "decimal(8,8)")
        highest = fine.cast("decimal(26,10)")
    return (
        quoted.groupBy(asset.alias("asset"), F.date_trunc("month", "o_orderdate").alias("bucket"))
        .agg(highest.alias("price"))
        .withColumn("price", F.when(missing, None).otherwise(F.col("price")))
        .withColumn(
            "decimals",
            F.when((F.col("asset") >= 0) & (F.col("asset") % 4 != 0), decimals_of(F.col("asset"))),
        )
    )


def leg_base(model: DataFrame, side: str) -> DataFrame:
    """A curated leg that agrees with the priced model: signed amounts, one row per event."""
    borrow = side == "debt"
    party = ("borrower", "repayer") if borrow else ("depositor", "withdrawn_to")
    return model.select(
        F.lit(LENDER["blockchain"]).alias("blockchain"),
        F.lit(LENDER["project"]).alias("project"),
        F.lit(LENDER["version"]).alias("version"),
        F.lit("borrow_liquidation" if borrow else "deposit_liquidation").alias("transaction_type"),
        F.trunc(F.col("block_time").cast("date"), "month").alias("block_month"),
        "block_time",
        "block_number",
        "project_contract_address",
        "tx_hash",
        F.col("evt_index").cast("int").alias("evt_index"),
        F.col(f"{side}_asset").alias("token_address"),
        F.col("borrower").alias(party[0]),
        F.col("liquidator").alias(party[1]),
        "liquidator",
        (-F.col(f"{side}_amount")).alias("amount"),
        F.col(f"{side}_amount_raw").alias("amount_raw"),
        (-F.col(f"{side}_amount_usd")).alias("amount_usd"),
        F.col(f"{side}_symbol").alias("symbol"),
    )


def seed_faults(leg: DataFrame, party: str) -> DataFrame:
    """Known faults by event key: drops, duplicates, foreign projects and field changes."""
    key = F.col("tx_hash")

    def hit(n: int) -> Column:
        return key % n == 0

    copies = F.concat(
        F.array(F.lit("lender")),
        F.when(hit(101), F.array(F.lit("lender"))).otherwise(F.array()),
        F.when(hit(61), F.array(F.lit("lender_fork"))).otherwise(F.array()),
        F.when(hit(122), F.array(F.lit("lender_lite"))).otherwise(F.array()),
    )
    changed = {
        "project": F.col("_project"),
        "amount_raw": F.when(hit(89), F.col("amount_raw") + 1)
        .otherwise(F.col("amount_raw"))
        .cast(RAW),
        "amount_usd": F.when(hit(83), None)
        .when(hit(79), F.col("amount_usd") * 2)
        .otherwise(F.col("amount_usd")),
        "token_address": F.when(hit(103), F.col("token_address") + 1).otherwise(
            F.col("token_address")
        ),
        party: F.when(hit(107), F.col(party) + 1).otherwise(F.col(party)),
        "block_number": F.when(hit(109), F.col("block_number") + 1).otherwise(
            F.col("block_number")
        ),
        "amount": F.when(hit(113), -F.col("amount")).otherwise(F.col("amount")),
    }
    kept = leg.where(~hit(97)).withColumn("_project", F.explode(copies))
    return kept.select(*[changed.get(c, F.col(c)).alias(c) for c in leg.columns])


def raw_transfers(spark: SparkSession, folder: str) -> DataFrame:
    """Transfers before the base filter; block time still per event."""
    events = table(spark, folder, "events")
    user, event = F.col("user_id"), F.col("event_id")
    count = table(spark, folder, "events").agg(F.max("user_id") + 1).scalar()
    t0 = (user * 31 + event * 7) % count
    token = F.when(F.col("event_type").isin("view", "click"), "A").when(
        F.col("event_type").isin("purchase", "signup"), "B"
    )
    paired = user % 5 < 2
    micro = (F.col("value").cast("decimal(18,2)") * 1000000).cast("bigint")
    day = F.date_diff(F.col("ts").cast("date"), F.lit("2024-01-01").cast("date"))
    five = F.floor(user / 5)
    return events.select(
        token.alias("token"),
        user.alias("sender"),
        F.when(user % 5 == 0, user + 1)
        .when(user % 5 == 1, user - 1)
        .otherwise(t0 - t0 % 5 + 2 + t0 % 3)
        .alias("receiver"),
        F.when(paired, F.lit(5000000)).otherwise(micro).cast(RAW).alias("value"),
        F.when(paired, 1000000000 + five * 1000 + day)
        .otherwise(F.floor(event / 3))
        .alias("tx_hash"),
        event.alias("evt_index"),
        F.col("ts").alias("event_time"),
    )


def transfers(spark: SparkSession, folder: str) -> DataFrame:
    """Eligible transfers; all events of one transaction share its block time."""
    rows = raw_transfers(spark, folder).where(
        base_transfer_filter(
            F.col("token"), F.col("sender"), F.col("receiver"), F.col("value"), TOKENS, ZERO_ADDRESS
        )
    )
    first = rows.groupBy("tx_hash").agg(F.min("event_time").alias("_first"))
    grain = F.when(F.col("tx_hash") % 2 == 0, F.date_trunc("day", "_first")).otherwise(
        F.date_trunc("hour", "_first")
    )
    timed = rows.join(first, "tx_hash").withColumn("block_time", grain)
    return timed.select(
        "token",
        "sender",
        "receiver",
        "value",
        "tx_hash",
        "evt_index",
        "block_time",
        F.col("block_time").cast("date").alias("block_date"),
        F.floor(F.unix_seconds("block_time") / 3600).alias("block_number"),
        (F.col("tx_hash") % 100).alias("tx_index"),
    )


def curated_transfers(spark: SparkSession, folder: str) -> DataFrame:
    """The curated twin, with dropped, changed and repeated rows."""
    event = F.col("evt_index")
    copies = F.when(event % 227 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    value = F.when(event % 223 == 0, F.col("value") + 1).otherwise(F.col("value"))
    return (
        transfers(spark, folder)
        .where(event % 211 != 0)
        .withColumn("_copy", F.explode(copies))
        .withColumn("value", value.cast(RAW))
        .drop("_copy")
    )


def transactions(transfer_rows: DataFrame) -> DataFrame:
    """One outer transaction per transfer-bearing hash."""
    tx = F.col("tx_hash")
    sender = F.min("sender")
    return transfer_rows.groupBy("tx_hash").agg(
        F.min("block_time").alias("block_time"),
        F.min("block_number").alias("block_number"),
        F.when(sender % 4 == 0, sender + 1).otherwise(sender).alias("tx_sender"),
    ).select(
        "tx_hash",
        "block_time",
        "block_number",
        F.col("block_time").cast("date").alias("block_date"),
        "tx_sender",
        ((21000 + (tx % 1000) * 50) * 10).alias("gas_used"),
        (1000000000 * (1 + tx % 50)).alias("gas_price"),
        F.lit(True).alias("success"),
    )


def hour_prices(transfer_rows: DataFrame) -> DataFrame:
    """Hourly price of the gas asset for every hour with a transfer."""
    hours = transfer_rows.select(F.date_trunc("hour", "block_time").alias("bucket")).distinct()
    return hours.select(
        F.lit("GAS").alias("asset"),
        "bucket",
        ((1500 + F.hour("bucket") * 10).cast("decimal(20,8)") + dec("0.45671234", "decimal(20,8)"))
        .cast("decimal(20,8)")
        .alias("price"),
    )


def addresses(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select(F.col("user_id").alias("address")).distinct()


def labels(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("address")
    names = F.when(key % 12 == 0, F.array(F.lit("usage"), F.lit("persona"))).otherwise(
        F.array(F.lit("usage"))
    )
    marked = addresses(spark, folder).where(key % 6 == 0)
    return marked.select("address", F.explode(names).alias("name"))


def exchange_list(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("address")
    names = F.when(key % 18 == 0, F.array(F.lit("main"), F.lit("alias"))).otherwise(
        F.array(F.lit("main"))
    )
    marked = addresses(spark, folder).where(key % 9 == 0)
    return marked.select("address", F.explode(names).alias("list_name"))
