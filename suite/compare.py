"""Runs registered queries against their SQL and reports differences.

    python -m suite.compare [sf_dir] [query ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import sys
import time
from collections import Counter

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _cell(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def _rows(columns: list[str], rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(
        tuple(_cell(row[i]) for i in order) for row in rows)


def differences(spark_rows, sql_result) -> list[str]:
    """Empty when both hold the same rows under the same names and column kinds."""
    left_names, left = _rows(spark_rows.columns, spark_rows.collect())
    right_names, right = _rows([d[0] for d in sql_result.description], sql_result.fetchall())
    if left_names != right_names:
        return [f"columns {left_names} <> {right_names}"]
    found = []
    if left != right:
        found.append(f"{sum(left.values())} rows <> {sum(right.values())} rows")
        found += [f"only spark {row}" for row in list((left - right))[:3]]
        found += [f"only sql   {row}" for row in list((right - left))[:3]]
    return found


KINDS = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
         "TIMESTAMP": "timestamp", "BOOLEAN": "boolean", "DATE": "date"}


def type_differences(spark_rows, sql_result) -> list[str]:
    kinds = dict(spark_rows.dtypes)
    return [f"{name}: {kinds.get(name)} <> {kind}" for name, kind, *_ in sql_result.description
            if KINDS.get(str(kind), str(kind)) != kinds.get(name)]


def main(arguments: list[str]) -> int:
    from suite.oracles import ORACLES
    from suite.queries import QUERIES
    from tillstream.session import build_session

    sf_dir = arguments[0] if arguments else "/root/testdata/sf0.01"
    names = arguments[1:] or list(QUERIES)
    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    bad = 0
    for name in names:
        start = time.time()
        try:
            rows = QUERIES[name](spark, sf_dir)
            count = rows.count() if name not in ORACLES else None
            found = []
            if name in ORACLES:
                found = differences(rows, connection.execute(ORACLES[name]))
                found += type_differences(rows, connection.execute(ORACLES[name]))
        except Exception as error:
            found, count = [str(error)[:1500]], None
        took = time.time() - start
        print(f"{'FAIL' if found else 'ok  '} {name} {took:.2f}s"
              f"{'' if count is None else f' rows only: {count}'}", flush=True)
        for line in found:
            print("    ", line, flush=True)
        bad += bool(found)
    print(f"{len(names) - bad} of {len(names)} match")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
