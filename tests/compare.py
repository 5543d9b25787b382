"""Spark rows against DuckDB rows, whatever their order."""

from collections import Counter
from datetime import date, datetime
from decimal import Decimal

import duckdb

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def connection(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return round(value, 9)
    if isinstance(value, Decimal):
        return float(value)
    return str(value) if isinstance(value, (date, datetime)) else value


def differences(frame, con, sql: str) -> str:
    """'' if both give the same columns and rows."""
    found = con.sql(sql)
    columns = sorted(frame.columns)
    if sorted(found.columns) != columns:
        return f"columns {columns} and {sorted(found.columns)}"
    listed = ", ".join(f'"{c}"' for c in columns)
    ours = Counter(tuple(map(_plain, r)) for r in frame.select(*columns).collect())
    theirs = Counter(tuple(map(_plain, r)) for r in con.sql(f"select {listed} from ({sql}) q").fetchall())
    return "" if ours == theirs else f"only Spark {list((ours - theirs).items())[:3]}, only DuckDB {list((theirs - ours).items())[:3]}"
