"""Order-insensitive comparison of a Spark frame with DuckDB rows."""

from __future__ import annotations

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def duck_rows(sf_dir: str, sql: str) -> tuple[list[str], list[tuple]]:
    connection = duckdb.connect()
    try:
        for table in TABLES:
            connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
        cursor = connection.execute(sql)
        columns = [column[0] for column in cursor.description]
        return columns, cursor.fetchall()
    finally:
        connection.close()


def _canonical(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def spark_rows(df: DataFrame) -> list[tuple]:
    return _canonical(df.columns, [tuple(row) for row in df.collect()])


def assert_same(df: DataFrame, sf_dir: str, sql: str) -> None:
    columns, rows = duck_rows(sf_dir, sql)
    assert sorted(df.columns) == sorted(columns)
    actual, expected = spark_rows(df), _canonical(columns, rows)
    assert len(actual) == len(expected)
    differing = [(a, e) for a, e in zip(actual, expected) if repr(a) != repr(e)]
    assert not differing, differing[:3]
