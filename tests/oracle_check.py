"""Comparison of a Spark result with a DuckDB result, by sorted rows."""

from __future__ import annotations

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')"
        )
    return connection


def _sorted(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    values = [tuple(row[i] for i in order) for row in rows]
    return sorted(columns), sorted(values, key=repr)


def spark_rows(df):
    return _sorted(df.columns, [tuple(row) for row in df.collect()])


def duckdb_rows(connection, sql):
    cursor = connection.execute(sql)
    return _sorted([d[0] for d in cursor.description], cursor.fetchall())
