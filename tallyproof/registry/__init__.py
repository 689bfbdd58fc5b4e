"""Named queries over the test tables, each with a DuckDB twin where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyproof.registry import fees, liquidations, screening

MODULES = (fees, liquidations, screening)


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: q for module in MODULES for name, q in module.QUERIES.items()}


def all_oracles() -> dict[str, str]:
    return {name: q for module in MODULES for name, q in module.ORACLES.items()}
