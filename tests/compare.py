"""Comparison of a Spark result with the same question asked in DuckDB."""

from __future__ import annotations

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duckdb_rows(sql: str, folder: str) -> tuple[list[str], list[tuple]]:
    with duckdb.connect() as connection:
        for table in TABLES:
            connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
        result = connection.execute(sql)
        return [column[0] for column in result.description], result.fetchall()


def ordered(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    """Columns by name, rows by value."""
    places = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in places], sorted(
        (tuple(row[i] for i in places) for row in rows), key=lambda row: tuple((v is not None, str(v)) for v in row)
    )


def assert_same(frame, sql: str, folder: str) -> None:
    got = ordered(frame.columns, [tuple(row) for row in frame.collect()])
    want = ordered(*duckdb_rows(sql, folder))
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1])
    assert got[1] == want[1]
