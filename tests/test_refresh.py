"""Bounds, partition replacement and the parity of incremental and full runs."""

from __future__ import annotations

import tempfile
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tallyproof.plans import refresh
from tallyproof.sources import releases, tables

START, TODAY = date(2024, 1, 1), date(2024, 2, 1)


def target():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp") + "/table"


def days(spark, first, last, mark="v1"):
    """Rows for January days ``first..last``, two per day."""
    return spark.range(first, last + 1).select(
        F.make_date(F.lit(2024), F.lit(1), F.col("id").cast("int")).alias("block_date"),
        F.explode(F.array(F.lit(0), F.lit(1))).alias("evt_index"),
        F.lit(mark).alias("mark"),
    )


def test_bounds_of_each_mode():
    full = refresh.refresh_bounds(START, TODAY, incremental=False)
    assert (full.start, full.end) == (START, TODAY)
    assert refresh.refresh_bounds(START, TODAY).start == START
    assert refresh.refresh_bounds(START, TODAY, newest=date(2024, 1, 20)).start == date(2024, 1, 18)
    assert refresh.refresh_bounds(START, TODAY, newest=date(2024, 1, 2)).start == START
    ended = refresh.refresh_bounds(START, TODAY, model_end=date(2024, 1, 10), incremental=False)
    assert ended.end == date(2024, 1, 10)
    window = (date(2023, 12, 1), date(2024, 3, 1))
    clipped = refresh.refresh_bounds(START, TODAY, backfill=window)
    assert (clipped.start, clipped.end) == (START, TODAY)


@pytest.mark.parametrize("window", [(START, None), (None, TODAY)])
def test_one_sided_backfill_is_an_error(window):
    with pytest.raises(ValueError, match="both"):
        refresh.refresh_bounds(START, TODAY, backfill=window)


def test_replacement_touches_only_dates_in_the_batch(spark):
    path = target()
    tables.trade_sink(days(spark, 1, 6), path, ["block_date", "evt_index", "mark"])
    tables.replace_partitions(days(spark, 5, 7, "v2"), path)
    rows = tables.read_table(spark, path).groupBy("mark").agg(F.count("*").alias("n")).collect()
    assert {r.mark: r.n for r in rows} == {"v1": 8, "v2": 6}


def test_an_emptied_date_stays_until_it_is_dropped(spark):
    path = target()
    tables.trade_sink(days(spark, 1, 3), path, ["block_date", "evt_index", "mark"])
    tables.replace_partitions(days(spark, 1, 3, "v2").where("block_date <> DATE '2024-01-02'"), path)
    assert tables.read_table(spark, path).where("mark = 'v1'").count() == 2
    assert tables.drop_partitions(spark, path, [date(2024, 1, 2), date(2024, 1, 30)]) == 1
    assert tables.read_table(spark, path).where("mark = 'v1'").count() == 0


def test_newest_date_of_missing_and_filled_targets(spark):
    path = target()
    assert tables.newest_date(spark, path) is None
    tables.trade_sink(days(spark, 1, 3), path, ["block_date", "evt_index", "mark"])
    assert tables.newest_date(spark, path) == date(2024, 1, 3)


def test_replaced_table_equals_its_simulation(spark):
    full = days(spark, 1, 9)
    bounds = refresh.refresh_bounds(START, TODAY, newest=date(2024, 1, 9))
    simulated = refresh.simulate_replacement(full, full.where(bounds.on()), bounds)
    assert simulated.exceptAll(full).count() == 0
    assert full.exceptAll(simulated).count() == 0


def test_frozen_relation_keeps_types_and_column_order(spark):
    df = days(spark, 1, 2).withColumn("amount", F.lit("1.5").cast("decimal(38,18)"))
    back = tables.frozen_relation(df, "test", "block_date")
    assert back.dtypes == df.dtypes
    assert back.exceptAll(df).count() == 0


def test_a_hot_date_is_cut_into_several_files(spark):
    path = target()
    rows = spark.range(200_000).select(
        F.lit(date(2024, 1, 1)).alias("block_date"), F.col("id").alias("evt_index"),
        F.md5(F.col("id").cast("string")).alias("mark"),
    )
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "1m")
    try:
        tables.trade_sink(rows.repartition(8), path, ["block_date", "evt_index", "mark"])
    finally:
        spark.conf.set(size, before)
    files = tables.read_table(spark, path).select(F.input_file_name()).distinct().count()
    assert files > 1
    assert tables.read_table(spark, path).count() == 200_000


def marks(spark, path) -> dict:
    return {r.mark: r.n for r in tables.read_table(spark, path).groupBy("mark").agg(F.count("*").alias("n")).collect()}


def test_a_run_that_dies_between_two_dates_changes_nothing(spark, monkeypatch):
    path = target()
    tables.trade_sink(days(spark, 1, 6), path, ["block_date", "evt_index", "mark"])
    # one date of a run is stored, the run never gets further
    half = f"{path}/data/release=dead"
    days(spark, 5, 5, "half").write.partitionBy("block_date").parquet(half)
    assert marks(spark, path) == {"v1": 12}
    # all dates are stored, the list is not renamed
    def killed(*args):
        raise KeyboardInterrupt

    monkeypatch.setattr(releases, "publish", killed)
    with pytest.raises(KeyboardInterrupt):
        tables.replace_partitions(days(spark, 5, 7, "v2"), path)
    assert marks(spark, path) == {"v1": 12}
    monkeypatch.undo()
    assert tables.replace_partitions(days(spark, 5, 7, "v2"), path) == [date(2024, 1, d) for d in (5, 6, 7)]
    assert marks(spark, path) == {"v1": 8, "v2": 6}


def test_of_two_runs_on_one_state_the_second_fails(spark):
    path = target()
    tables.trade_sink(days(spark, 1, 3), path, ["block_date", "evt_index", "mark"])
    base = releases.release(spark, path)
    releases.replace(days(spark, 2, 2, "v2"), path, "block_date", base)
    with pytest.raises(RuntimeError, match="another run"):
        releases.replace(days(spark, 3, 3, "v3"), path, "block_date", base)
    assert marks(spark, path) == {"v1": 4, "v2": 2}


def test_readers_keep_the_state_they_resolved(spark):
    path = target()
    tables.trade_sink(days(spark, 1, 3), path, ["block_date", "evt_index", "mark"])
    before = tables.read_table(spark, path)
    # a batch may read the table that it replaces
    changed = tables.read_table(spark, path).where("block_date = DATE '2024-01-02'").withColumn("mark", F.lit("v2"))
    tables.replace_partitions(changed, path)
    tables.replace_partitions(days(spark, 1, 2, "v3").where("block_date = DATE '2024-01-01'"), path, drop=[date(2024, 1, 1), date(2024, 1, 3)])
    assert marks(spark, path) == {"v2": 2, "v3": 2}
    assert before.groupBy("mark").count().collect()[0]["count"] == 6
    assert releases.expire(spark, path, keep=1) == 1
    assert marks(spark, path) == {"v2": 2, "v3": 2}
    assert tables.drop_partitions(spark, path, [date(2024, 1, 1), date(2024, 1, 2)]) == 2
    assert tables.read_table(spark, path).count() == 0 and tables.newest_date(spark, path) is None


def test_newest_date_and_inventory_open_no_data(spark):
    path = target()
    rows = spark.range(2500).select(F.date_add(F.lit(date(1995, 1, 1)), F.col("id").cast("int")).alias("block_date"), "id")
    tables.trade_sink(rows.repartition(1), path, ["block_date", "id"])
    files = [p for p in Path(path).rglob("*.parquet")]
    assert len(files) == 2500
    for file in files:
        file.chmod(0)
    spark.catalog.clearCache()
    group = "newest-date"
    spark.sparkContext.setJobGroup(group, group)
    assert tables.newest_date(spark, path) == date(2001, 11, 4)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    for file in files:
        file.chmod(0o644)
    inventory = tables.table_inventory(spark, path)
    assert "ReadSchema: struct<>" in inventory._jdf.queryExecution().executedPlan().toString()
    assert tuple(inventory.first()) == (2500, 2500, date(1995, 1, 1), date(2001, 11, 4))
    plain = f"{target()}"
    days(spark, 1, 3).write.partitionBy("block_date").parquet(plain)
    assert tables.newest_date(spark, plain) == date(2024, 1, 3)
