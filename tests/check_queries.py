"""Compare registered queries with their SQL on one test folder.

    python tests/check_queries.py [sf_dir] [query ...]
"""

from __future__ import annotations

import sys
import time
from decimal import Decimal
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as contract  # noqa: E402
from estatelake.staging import release  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return connection


def normal(value):
    if isinstance(value, Decimal):
        return int(value) if value == value.to_integral_value() else float(value)
    if isinstance(value, float) and value == 0:
        return 0.0
    return value


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cleaned = [tuple(normal(row[i]) for i in order) for row in rows]
    return sorted(columns), sorted(cleaned, key=lambda r: tuple((v is None, str(type(v)), str(v)) for v in r))


def compare(spark, connection, name: str, sf_dir: str) -> str:
    """'' when equal, else what differs."""
    frame = contract.queries()[name](spark, sf_dir)
    found = sorted_rows(frame.columns, [tuple(r) for r in frame.collect()])
    sql = contract.oracle_sql().get(name)
    if sql is None:
        return "" if found[1] else "no rows"
    cursor = connection.execute(sql)
    wanted = sorted_rows([d[0] for d in cursor.description], cursor.fetchall())
    if found[0] != wanted[0]:
        return f"columns {found[0]} vs {wanted[0]}"
    if len(found[1]) != len(wanted[1]):
        return f"rows {len(found[1])} vs {len(wanted[1])}"
    different = [(a, b) for a, b in zip(found[1], wanted[1]) if a != b]
    return f"{len(different)} of {len(wanted[1])} rows differ: {different[:3]}" if different else ""


def main() -> None:
    from pyspark.sql import SparkSession

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(contract.queries())
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = duck(sf_dir)
    bad = 0
    for name in names:
        start = time.time()
        try:
            problem = compare(spark, connection, name, sf_dir)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:900]}"
        kind = "sql" if name in contract.oracle_sql() else "rows"
        print(f"{name:26s} {kind:5s} {time.time() - start:6.1f}s {problem or 'ok'}", flush=True)
        bad += bool(problem)
    release(spark)
    print(f"{len(names)} queries, {bad} bad")


if __name__ == "__main__":
    main()
