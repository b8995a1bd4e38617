"""Compare a query's result with its SQL twin, value by value."""

from __future__ import annotations

import os
from pathlib import Path

import duckdb

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def _sorted(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def compare(spark, sf_dir, query, sql):
    df = query(spark, sf_dir)
    got = _sorted([tuple(r) for r in df.collect()], df.columns)
    cursor = connect(sf_dir).execute(sql)
    columns = [d[0] for d in cursor.description]
    want = _sorted(cursor.fetchall(), columns)
    assert sorted(df.columns) == sorted(columns)
    assert len(got) == len(want)
    for a, b in zip(got, want):
        assert a == b
    return len(got)
