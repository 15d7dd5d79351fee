"""Order-free comparison of a Spark result with the SQL twin's."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
]


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = Path(folder) / f"{name}.parquet"
        if path.exists():
            files = path / "*.parquet" if path.is_dir() else path
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{files}')")
    return con


def cell(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    if hasattr(value, "isoformat"):
        return value.isoformat()
    return value


def rows(columns: list[str], records) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    found = [tuple(cell(record[i]) for i in order) for record in records]
    return sorted(found, key=repr)


def spark_rows(df):
    return sorted(df.columns), rows(df.columns, df.collect())


def duck_rows(con, sql):
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    return sorted(columns), rows(columns, result.fetchall())
