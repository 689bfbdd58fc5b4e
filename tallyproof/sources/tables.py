"""Date-partitioned model tables and frozen relations."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyproof.session import fresh_path, session_conf
from tallyproof.sources import releases

PARTITION = "block_date"


def trade_sink(df: DataFrame, path: str, columns: Sequence[str], partition: str = PARTITION) -> str:
    """Write the published columns as complete partitions; they become the whole table at once."""
    releases.replace(df.select(*columns), path, partition, None)
    return path


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The newest published state of a table, or the files of a plain folder."""
    # One listing task per core instead of one per date directory.
    cores = str(max(spark.sparkContext.defaultParallelism, 1))
    with session_conf(spark, spark__sql__sources__parallelPartitionDiscovery__parallelism=cores):
        state = releases.release(spark, path)
        if state:
            return releases.read(spark, path, state)
        reader = spark.read.schema(schema) if schema else spark.read
        return reader.parquet(path)


def replace_partitions(
    df: DataFrame, path: str, partition: str = PARTITION, drop: Sequence[date] = ()
) -> list[date]:
    """Replace exactly the dates present in ``df``, all of them at once; these dates.

    A date that became empty keeps its old rows, as with delete-and-insert keyed on the new
    batch, unless ``drop`` names it. ``df`` may read the state it replaces.
    """
    base = releases.release(df.sparkSession, path)
    gone = [day.isoformat() for day in drop]
    _, values = releases.replace(df, path, partition, base, gone)
    return [date.fromisoformat(v) for v in values]


def drop_partitions(spark: SparkSession, path: str, dates: Sequence[date]) -> int:
    """Take dates that a backfill found empty out of the table; how many it held."""
    base = releases.release(spark, path)
    return releases.without(spark, path, base, [d.isoformat() for d in dates]) if base else 0


def held_dates(spark: SparkSession, path: str, partition: str = PARTITION) -> list[date]:
    """Dates of a table from its list, or from the folder names of a plain one: no file is opened."""
    state = releases.release(spark, path)
    values = state.held if state else releases.partition_values(spark, path, partition)
    return sorted(date.fromisoformat(v) for v in values)


def newest_date(spark: SparkSession, path: str, partition: str = PARTITION) -> date | None:
    """Latest date of a target; None when its folder is missing or has no dates."""
    return max(held_dates(spark, path, partition), default=None)


def table_inventory(spark: SparkSession, path: str, partition: str = PARTITION) -> DataFrame:
    """Rows, dates and first and last date. No column is read: rows are counted from footers."""
    dates = held_dates(spark, path, partition)
    first, last = (dates[0], dates[-1]) if dates else (None, None)
    return read_table(spark, path).agg(F.count("*").alias("row_count")).select(
        "row_count", F.lit(len(dates)).alias("dates"),
        F.lit(first).cast("date").alias("first_date"), F.lit(last).cast("date").alias("last_date"),
    )


def frozen_relation(df: DataFrame, label: str, partition: str | None = None) -> DataFrame:
    """Store an accepted result and read it back with its declared types.

    Later checks read the stored rows instead of rebuilding them, and lineage ends here. The
    copy is in the shared folder, so it outlives any executor.
    """
    path = fresh_path(df.sparkSession, label)
    writer = df.write.mode("errorifexists")
    if partition:
        writer = writer.partitionBy(partition)
    writer.parquet(path)
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema.fields])
    return read_table(df.sparkSession, path, schema).select(*df.columns)
