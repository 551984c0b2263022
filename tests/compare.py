"""Compare a registered Spark query with its DuckDB statement."""

from __future__ import annotations

import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        if os.path.exists(path):
            con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    columns = sorted(df.columns)
    return columns, _ordered([tuple(row) for row in df.select(*columns).collect()])


def oracle_rows(con, sql: str) -> tuple[list[str], list[tuple]]:
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], _ordered([tuple(row[i] for i in order) for row in result.fetchall()])


def _ordered(rows: list[tuple]) -> list[tuple]:
    return sorted(rows, key=repr)


def difference(df, con, sql: str) -> str | None:
    """None when both sides hold the same columns and rows, else a short description."""
    spark_columns, left = spark_rows(df)
    oracle_columns, right = oracle_rows(con, sql)
    if spark_columns != oracle_columns:
        return f"columns {spark_columns} vs {oracle_columns}"
    if len(left) != len(right):
        only_left, only_right = set(left) - set(right), set(right) - set(left)
        return f"rows {len(left)} vs {len(right)}; e.g. {list(only_left)[:2]} vs {list(only_right)[:2]}"
    differing = [(a, b) for a, b in zip(left, right) if repr(a) != repr(b)]
    return f"{len(differing)} of {len(left)} rows differ, e.g. {differing[0]}" if differing else None
