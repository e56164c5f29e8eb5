"""Run a query on Spark and its SQL on DuckDB over the same files, and compare."""

from __future__ import annotations

import datetime
import glob
import os

import pandas as pd

import duckdb


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{sf}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _plain(value):
    if value is None or value is pd.NaT:
        return None
    if isinstance(value, float):
        return "nan" if value != value else value
    if isinstance(value, (datetime.datetime, pd.Timestamp)):
        return value.isoformat()
    return value


def sorted_rows(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(plain, key=repr)


def spark_rows(df):
    return sorted_rows(df.columns, [tuple(row) for row in df.collect()])


def duckdb_rows(connection, sql: str):
    result = connection.execute(sql)
    return sorted_rows([d[0] for d in result.description], result.fetchall())


SPARK_TYPES = {"VARCHAR": "string", "INTEGER": "int", "BIGINT": "bigint", "DOUBLE": "double", "BOOLEAN": "boolean"}


def duckdb_types(connection, sql: str) -> dict[str, str]:
    described = connection.execute(f"DESCRIBE {sql}").fetchall()
    return {row[0]: SPARK_TYPES.get(row[1], row[1]) for row in described}
