"""Runs catalogue queries on Spark and their SQL on DuckDB and compares the rows."""

from __future__ import annotations

import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(directory: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{directory}/{name}.parquet'")
    return connection


def _cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return ""
    if isinstance(value, bool):
        return str(value).lower()
    return repr(float(value)) if isinstance(value, float) else str(value)


def rows(columns, tuples):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_cell(row[i]) for i in order) for row in tuples)


def spark_rows(df):
    return rows(df.columns, [tuple(row) for row in df.collect()])


def duck_rows(connection, sql):
    result = connection.execute(sql)
    return rows([column[0] for column in result.description], result.fetchall())


def differences(left, right, limit: int = 3) -> str:
    """Empty if both sides are equal, else what differs."""
    if left[0] != right[0]:
        return f"columns {left[0]} vs {right[0]}"
    if left[1] == right[1]:
        return ""
    only_left, only_right = set(left[1]) - set(right[1]), set(right[1]) - set(left[1])
    return (
        f"{len(left[1])} vs {len(right[1])} rows; {left[0]}\n spark only: {sorted(only_left)[:limit]}\n"
        f" sql only: {sorted(only_right)[:limit]}"
    )
