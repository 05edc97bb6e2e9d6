"""Comparing a Spark result with another engine's, regardless of row and column order."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame

TABLES = [
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
]


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        if path.exists():
            con.sql(f"create view {name} as select * from read_parquet('{path}')")
    return con


def _value(v):
    if isinstance(v, float) and math.isnan(v):
        return "NaN"
    return v


def rows_of(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    picked = [tuple(_value(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(picked, key=repr)


def spark_rows(df: DataFrame):
    return rows_of(df.columns, df.collect())


def duckdb_rows(con: duckdb.DuckDBPyConnection, sql: str):
    result = con.sql(sql)
    return rows_of(result.columns, result.fetchall())


def kinds(rows: list[tuple]) -> list[set[str]]:
    return [{type(v).__name__ for v in column if v is not None} for column in zip(*rows)] if rows else []
