"""Compare a Spark query with its DuckDB oracle the way the driver does:
row count, column names (sorted), and an order-insensitive hash of values."""

from __future__ import annotations

import datetime as dt
import hashlib
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return repr(float(v))
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    return str(v)


def digest(columns: list[str], rows: list[tuple]) -> tuple[int, list[str], str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(str(_norm(r[i])) for i in order) for r in rows)
    h = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return len(rows), sorted(columns), h


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    return df.columns, [tuple(r) for r in df.collect()]


def duck_rows(con, sql: str) -> tuple[list[str], list[tuple]]:
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    return cols, cur.fetchall()


def diff(spark_res, duck_res, limit: int = 5) -> str:
    sc, sr = spark_res
    dc, dr = duck_res
    so = sorted(range(len(sc)), key=lambda i: sc[i])
    do = sorted(range(len(dc)), key=lambda i: dc[i])
    s = sorted(tuple(_norm(r[i]) for i in so) for r in sr)
    d = sorted(tuple(_norm(r[i]) for i in do) for r in dr)
    ss, ds = set(s), set(d)
    only_s = [r for r in s if r not in ds][:limit]
    only_d = [r for r in d if r not in ss][:limit]
    return f"cols spark={sorted(sc)} duck={sorted(dc)}\nonly spark: {only_s}\nonly duck: {only_d}"
