"""Compare queries with their SQL: ``python tests/check_oracles.py [sf_dir] [name ...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import duckdb
from pyspark.sql import SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def sql_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def canonical(names: list[str], rows: list[tuple]) -> list[tuple]:
    """Rows with columns sorted by name and values as text, in a fixed order."""
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(str(r[i]) for i in order) for r in rows)


def compare(spark: SparkSession, connection, sf_dir: str, name: str) -> tuple[bool, str]:
    from feedloom.catalog import ORACLES, QUERIES

    started = time.time()
    frame = QUERIES[name](spark, sf_dir)
    rows = [tuple(r) for r in frame.collect()]
    took = time.time() - started
    plan = frame._jdf.queryExecution().toString()
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin"):
        if node in plan:
            return False, f"{node} in the plan"
    if name not in ORACLES:
        return bool(rows), f"{len(rows)} rows, no SQL, {took:.1f}s"
    answer = connection.sql(ORACLES[name])
    expected = answer.fetchall()
    if sorted(frame.columns) != sorted(answer.columns):
        return False, f"columns {sorted(frame.columns)} != {sorted(answer.columns)}"
    left, right = canonical(frame.columns, rows), canonical(answer.columns, expected)
    if left == right:
        return bool(rows), f"{len(rows)} rows, {took:.1f}s"
    only_left = list(set(left) - set(right))[:2]
    only_right = list(set(right) - set(left))[:2]
    return False, f"{len(rows)} vs {len(expected)} rows\n   spark {only_left}\n   sql   {only_right}"


def main() -> int:
    from feedloom.catalog import QUERIES

    arguments = sys.argv[1:]
    sf_dir = arguments.pop(0) if arguments and arguments[0].startswith("/") else "/root/testdata/sf0.01"
    spark, connection = session(), sql_connection(sf_dir)
    bad = 0
    for name in arguments or QUERIES:
        try:
            ok, note = compare(spark, connection, sf_dir, name)
        except Exception as error:  # noqa: BLE001
            ok, note = False, str(error)[:900]
        bad += not ok
        print("ok  " if ok else "FAIL", name, note, flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())
