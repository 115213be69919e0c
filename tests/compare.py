"""Comparison of a Spark result with the SQL over the same tables."""

from __future__ import annotations

import datetime
import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        path = Path(folder) / f"{table}.parquet"
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, datetime.date):
        return value.isoformat()
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(columns), sorted(plain, key=lambda r: tuple((v is None, str(v)) for v in r))


def spark_rows(frame):
    return _rows(frame.columns, [tuple(r) for r in frame.collect()])


def sql_rows(connection, sql):
    cursor = connection.execute(sql)
    return _rows([d[0] for d in cursor.description], cursor.fetchall())


# Spark type to the SQL engine's name for it.
TYPES = {
    "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
    "date": "DATE", "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN",
}


def type_differences(frame, connection, sql):
    described = {r[0]: r[1] for r in connection.execute(f"DESCRIBE {sql}").fetchall()}
    spark = {name: TYPES.get(kind, kind) for name, kind in frame.dtypes}
    return {
        name: (spark.get(name), described.get(name))
        for name in spark.keys() | described.keys()
        if spark.get(name) != described.get(name)
    }
