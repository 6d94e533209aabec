"""Run registered queries against DuckDB on the same Parquet files.

``python -m tests.oracle SF_DIR [QUERY ...]`` prints one line per query.
"""

from __future__ import annotations

import math
import sys
import time
import traceback
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

DUCKDB_TYPE = {
    "bigint": "BIGINT", "boolean": "BOOLEAN", "date": "DATE", "double": "DOUBLE", "float": "FLOAT", "int": "INTEGER",
    "smallint": "SMALLINT", "string": "VARCHAR", "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{Path(sf_dir) / name}.parquet')")
    return connection


def _cell(value: object) -> str:
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else repr(value + 0.0)
    if hasattr(value, "tzinfo") and value.tzinfo is not None:
        value = value.replace(tzinfo=None)
    return repr(value)


def _rows(columns: list[str], rows: list) -> list[tuple[str, ...]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def differences(connection: duckdb.DuckDBPyConnection, result: DataFrame, sql: str) -> list[str]:
    """What differs between a Spark result and a query's SQL; empty when equal."""
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    expected = _rows(names, cursor.fetchall())
    problems = []
    if sorted(names) != sorted(result.columns):
        return [f"columns {sorted(result.columns)} instead of {sorted(names)}"]
    wanted = {r[0]: r[1] for r in connection.execute(f"DESCRIBE {sql}").fetchall()}
    for name, dtype in result.dtypes:
        mapped = DUCKDB_TYPE.get(dtype, dtype.upper().replace(" ", ""))
        if mapped != wanted[name].replace(" ", ""):
            problems.append(f"{name} is {dtype}, SQL has {wanted[name]}")
    found = _rows(result.columns, result.collect())
    if len(found) != len(expected):
        problems.append(f"{len(found)} rows instead of {len(expected)}")
    if found != expected:
        extra = sorted(set(found) - set(expected))[:2]
        missing = sorted(set(expected) - set(found))[:2]
        problems.append(f"values differ: found {extra}, expected {missing}")
    return problems


def main(sf_dir: str, only: list[str]) -> int:
    import __spark_entry__
    from lakeproof.session import local_session

    spark = local_session(8)
    connection = connect(sf_dir)
    queries, oracles = __spark_entry__.queries(), __spark_entry__.oracle_sql()
    failures = 0
    for name in only or queries:
        started = time.time()
        try:
            result = queries[name](spark, sf_dir)
            if name in oracles:
                problems = differences(connection, result, oracles[name])
            else:
                problems = [] if result.count() > 0 else ["no rows"]
        except Exception:
            problems = [traceback.format_exc(limit=-3)[-1500:]]
        failures += bool(problems)
        kind = "sql" if name in oracles else "rows"
        print(f"{'FAIL' if problems else 'ok':4} {kind:4} {time.time() - started:6.1f}s {name} {' | '.join(problems)}", flush=True)
    print(f"{len(only or queries)} queries, {failures} failed")
    return 1 if failures else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
