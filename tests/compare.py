"""Compare a Spark result with the same query in DuckDB, order-insensitively."""

from __future__ import annotations

import math
from decimal import Decimal
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = Path(folder) / f"{name}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def cell(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    if isinstance(value, Decimal):
        return str(value.quantize(Decimal("0.01")))
    return repr(value)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


def oracle_rows(con, sql):
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    return sorted(names), rows_of(names, cursor.fetchall())


def spark_rows(df):
    return sorted(df.columns), rows_of(df.columns, df.collect())
