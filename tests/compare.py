"""Run queries and their DuckDB counterparts side by side.

    python tests/compare.py [folder] [query ...]
"""

from __future__ import annotations

import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(folder: str):
    db = duckdb.connect()
    for table in TABLES:
        db.sql(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return db


def _sorted(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(
        (tuple(row[i] for i in order) for row in rows), key=lambda row: [(v is not None, str(v)) for v in row]
    )


def spark_result(df):
    return _sorted(df.columns, [tuple(row) for row in df.collect()])


def duckdb_result(db, text):
    result = db.sql(text)
    return _sorted(result.columns, result.fetchall())


def difference(spark, db, folder, run, text) -> str | None:
    """None when equal, else a short account of what differs."""
    columns, rows = spark_result(run(spark, folder))
    expected_columns, expected = duckdb_result(db, text)
    if columns != expected_columns:
        return f"columns {columns} != {expected_columns}"
    if len(rows) != len(expected):
        return f"{len(rows)} rows, expected {len(expected)}"
    for got, want in zip(rows, expected):
        if got != want or [type(v) for v in got] != [type(v) for v in want]:
            return f"{got} != {want}"
    return None


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries
    from funil.settings import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session("compare")
    spark.sparkContext.setLogLevel("ERROR")
    db = connect(folder)
    oracle = oracle_sql()
    bad = 0
    for name, run in queries().items():
        if len(sys.argv) > 2 and name not in sys.argv[2:]:
            continue
        started = time.time()
        try:
            problem = difference(spark, db, folder, run, oracle[name]) if name in oracle else "no oracle"
        except Exception as error:  # report and go on
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{name:28} {time.time() - started:6.2f}s  {'ok' if problem is None else 'BAD ' + problem}", flush=True)
    print("bad:", bad)
    sys.exit(bad > 0)
