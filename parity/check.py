"""Runs every registered query beside its SQL: ``python -m parity.check [sf_dir] [names...]``."""

from __future__ import annotations

import math
import sys
import time
from decimal import Decimal

import duckdb
from pyspark.sql import SparkSession

from bazaarline.session import local_session
from parity.oracles import ORACLES
from parity.queries import REGISTRY

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def duckdb_on(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def _value(value):
    if isinstance(value, Decimal):
        raise TypeError("decimals must be cast to double")
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return "" if value is None else str(value)


def _rows(columns, rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_value(row[i]) for i in order) for row in rows)


def difference(
    spark: SparkSession, connection: duckdb.DuckDBPyConnection, sf_dir: str, name: str
) -> str | None:
    """What differs between a query and its SQL; ``None`` if nothing does."""
    df = REGISTRY[name](spark, sf_dir)
    cursor = connection.execute(ORACLES[name])
    expected_columns = [item[0] for item in cursor.description]
    if sorted(df.columns) != sorted(expected_columns):
        return f"columns {sorted(df.columns)} / {sorted(expected_columns)}"
    expected = _rows(expected_columns, cursor.fetchall())
    actual = _rows(df.columns, df.collect())
    if len(actual) != len(expected):
        return f"{len(actual)} / {len(expected)} rows"
    for left, right in zip(actual, expected, strict=True):
        if left != right:
            return f"first difference in {sorted(df.columns)}: {left} / {right}"
    return None


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or sorted(REGISTRY)
    spark = local_session("parity")
    connection = duckdb_on(sf_dir)
    bad = 0
    for name in names:
        started = time.monotonic()
        try:
            problem = difference(spark, connection, sf_dir, name)
        except Exception as error:  # report and go on with the other queries
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{time.monotonic() - started:6.2f}s {name}: {problem or 'ok'}", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")
    return bad


if __name__ == "__main__":
    sys.exit(min(main(), 1))
