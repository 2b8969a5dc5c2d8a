"""Compare registered queries with their oracle SQL: ``python -m tests.oracle SF_DIR [NAME ...]``."""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time

import duckdb
from pyspark.sql import SparkSession

import __spark_entry__ as contract

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

# DuckDB type of each Spark type that the queries return.
TYPES = {
    "string": "VARCHAR", "double": "DOUBLE", "bigint": "BIGINT", "int": "INTEGER",
    "date": "DATE", "boolean": "BOOLEAN",
}


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _cell(x):
    if isinstance(x, float):
        return "NaN" if math.isnan(x) else x + 0.0
    if isinstance(x, decimal.Decimal):
        return float(x)
    if isinstance(x, datetime.datetime):
        return x.isoformat()
    return x


def _sorted_rows(rows):
    return sorted(
        (tuple(_cell(c) for c in row) for row in rows),
        key=lambda r: tuple((c is None, str(type(c)), str(c)) for c in r),
    )


def mismatch(spark: SparkSession, con: duckdb.DuckDBPyConnection, sf_dir: str, name: str) -> str | None:
    """None when columns, types and rows agree, else what differs."""
    df = contract.queries()[name](spark, sf_dir)
    columns = sorted(df.columns)
    rows = _sorted_rows(df.select(*[f"`{c}`" for c in columns]).collect())
    if name not in contract.oracle_sql():
        return None if rows else "no rows"
    relation = con.execute(contract.oracle_sql()[name])
    described = {d[0]: str(d[1]) for d in relation.description}
    raw = relation.fetchall()
    order = list(described)
    if sorted(order) != columns:
        return f"columns {columns} against {sorted(order)}"
    types = dict(df.dtypes)
    wrong = {c: (types[c], described[c]) for c in columns if TYPES.get(types[c]) != described[c]}
    if wrong:
        return f"types {wrong}"
    expected = _sorted_rows([[row[order.index(c)] for c in columns] for row in raw])
    if len(rows) != len(expected):
        return f"{len(rows)} rows against {len(expected)}"
    if not rows:
        return "no rows"
    differing = [(a, b) for a, b in zip(rows, expected) if a != b]
    if differing:
        return f"{len(differing)} of {len(rows)} rows differ in {columns}: {differing[0]}"
    return None


def main(sf_dir: str, names: list[str]) -> int:
    from demandspark.session import build_session

    spark = build_session("oracle", "local[8]", spark__sql__shuffle__partitions="8",
                          spark__ui__enabled="false", spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    con = oracle_connection(sf_dir)
    failed = 0
    for name in names or contract.queries():
        start = time.time()
        try:
            problem = mismatch(spark, con, sf_dir, name)
        except Exception as e:  # noqa: BLE001 - report and go on
            problem = f"{type(e).__name__}: {str(e)[:1500]}"
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {time.time() - start:6.2f}s {name} {problem or ''}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1], sys.argv[2:])))
