"""Every registered query against its DuckDB twin on the smallest test tables."""

from __future__ import annotations

import pytest
from compare import connect, rows_of

from __spark_entry__ import entry
from tallyproof.registry import all_oracles, all_queries

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_every_query_has_a_twin():
    assert set(all_queries()) == set(all_oracles())


def test_entry_runs(spark):
    assert entry(spark).count() == 1


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query_equals_its_twin(spark, duck, name):
    df = all_queries()[name](spark, FOLDER)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cursor = duck.execute(all_oracles()[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert got == rows_of(columns, cursor.fetchall())


# Queries that divide; values next to a half are met only on more rows.
DIVIDING = [
    "adjacent_windows", "class_partition", "external_metric_gap", "impact_table",
    "interval_features", "movement_profile", "scan_reduction",
]


@pytest.mark.parametrize("name", DIVIDING)
def test_dividing_query_equals_its_twin_on_more_rows(spark, name):
    folder = "/root/testdata/sf0.01"
    df = all_queries()[name](spark, folder)
    cursor = connect(folder).execute(all_oracles()[name])
    columns = [c[0] for c in cursor.description]
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(columns, cursor.fetchall())
