"""Compare a Spark result with SQL on the same Parquet tables."""

from __future__ import annotations

import datetime
import decimal
import math
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for p in Path(sf_dir).glob("*.parquet"):
        source = f"{p}/*.parquet" if p.is_dir() else str(p)
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{source}')")
    return con


def _plain(x: object) -> object:
    if isinstance(x, bool) or x is None:
        return x
    if isinstance(x, decimal.Decimal):
        return float(x) if x != int(x) else int(x)
    if isinstance(x, float):
        return None if math.isnan(x) else (int(x) if x == int(x) else float(f"{x:.9g}"))
    if isinstance(x, datetime.datetime):
        return x.replace(tzinfo=None).isoformat()
    return list(map(_plain, x)) if isinstance(x, list) else x


def rows_of_spark(df: DataFrame) -> tuple[list[str], list[tuple]]:
    names = sorted(df.columns)
    return names, sorted((tuple(_plain(r[n]) for n in names) for r in df.collect()), key=repr)


def rows_of_sql(con: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], list[tuple]]:
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted((tuple(_plain(r[i]) for i in order) for r in cursor.fetchall()), key=repr)


def difference(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None if both give the same columns and rows, else what differs."""
    a_names, a = rows_of_spark(df)
    b_names, b = rows_of_sql(con, sql)
    if a_names != b_names:
        return f"columns {a_names} and {b_names}"
    if len(a) != len(b):
        return f"{len(a)} and {len(b)} rows"
    for x, y in zip(a, b, strict=True):
        if x != y:
            return f"{x} and {y}"
    return None
