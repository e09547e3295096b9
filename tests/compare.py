"""Run a registered query in Spark and in DuckDB and compare all values."""

from __future__ import annotations

import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for table in TABLES:
        path = os.path.join(folder, f"{table}.parquet")
        db.execute(f"create view {table} as select * from '{path}'")
    return db


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    names = sorted(df.columns)
    return names, sorted(map(_key, (tuple(r) for r in df.select(names).collect())))


def duck_rows(db, sql: str) -> tuple[list[str], list[tuple]]:
    result = db.execute(sql)
    names = [d[0] for d in result.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    rows = [tuple(r[i] for i in order) for r in result.fetchall()]
    return sorted(names), sorted(map(_key, rows))


def _key(row: tuple) -> tuple:
    return tuple(("", "") if v is None else (type(v).__name__, v) for v in row)
