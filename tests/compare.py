"""Runs registered queries next to their DuckDB twins and compares every value."""

from __future__ import annotations

import sys
import time
from decimal import Decimal
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def canonical(value: object) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, Decimal):
        return f"d{value:f}"
    if isinstance(value, bool):
        return f"b{value}"
    if isinstance(value, (int, float)):
        return f"{type(value).__name__[0]}{value!r}"
    return f"{type(value).__name__}:{value}"


def rows_of(columns: list[str], rows: list[tuple]) -> list[tuple[str, ...]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(canonical(r[i]) for i in order) for r in rows)


def compare(spark, folder: str, name: str, query, sql: str | None, con) -> tuple[bool, str]:
    start = time.time()
    df = query(spark, folder)
    got = [tuple(r) for r in df.collect()]
    took = time.time() - start
    if sql is None:
        return True, f"{name}: rows={len(got)} no oracle spark={took:.1f}s"
    start = time.time()
    cursor = con.execute(sql)
    columns = [c[0] for c in cursor.description]
    want = cursor.fetchall()
    oracle_took = time.time() - start
    tail = f"rows={len(got)} spark={took:.1f}s duckdb={oracle_took:.1f}s"
    if sorted(columns) != sorted(df.columns):
        return False, f"{name}: columns {sorted(df.columns)} != {sorted(columns)} {tail}"
    left, right = rows_of(df.columns, got), rows_of(columns, want)
    if left != right:
        gap = [
            (a, b) for a, b in zip(left, right, strict=False) if a != b
        ][:2]
        names = sorted(columns)
        shown = []
        for a, b in gap:
            shown.append({n: (x, y) for n, x, y in zip(names, a, b, strict=True) if x != y})
        return False, f"{name}: {len(left)} vs {len(right)} rows, {shown} {tail}"
    if not got:
        return False, f"{name}: EMPTY {tail}"
    return True, f"{name}: ok {tail}"


def main() -> None:
    from __spark_entry__ import oracle_sql, queries
    from tallyproof.session import build_session

    folder = sys.argv[1]
    chosen = sys.argv[2:]
    spark = build_session(
        master="local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
           "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    oracles = oracle_sql()
    todo = {k: v for k, v in queries().items() if not chosen or k in chosen}
    bad = 0
    for name, query in todo.items():
        try:
            good, text = compare(spark, folder, name, query, oracles.get(name), con)
        except Exception as error:  # noqa: BLE001 - report and go on with the next query
            good, text = False, f"{name}: {type(error).__name__} {str(error)[:900]}"
        bad += not good
        print("PASS" if good else "FAIL", text, flush=True)
        spark.catalog.clearCache()
    print(f"{len(todo) - bad} of {len(todo)} agree", flush=True)


if __name__ == "__main__":
    main()
