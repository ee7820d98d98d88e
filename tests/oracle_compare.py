"""Run a registered query and its DuckDB oracle on the same tables and compare
(column names, row count, order-insensitive values), like the driver does."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v, digits):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, digits) if digits is not None else v
    if isinstance(v, decimal.Decimal):
        return _norm(float(v), digits)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, (bytes, bytearray)):
        return bytes(v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x, digits)) for k, x in v.items()))
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x, digits) for x in v)
    return v


def _rows(cols, rows, digits):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i], digits) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


def compare(spark, con, fn, sql, sf_dir, digits=None):
    sdf = fn(spark, sf_dir)
    s_cols = list(sdf.columns)
    s_rows = [tuple(r) for r in sdf.collect()]
    cur = con.execute(sql)
    d_cols = [d[0] for d in cur.description]
    d_rows = cur.fetchall()
    problems = []
    if len(set(s_cols)) != len(s_cols):
        problems.append(f"duplicate column names: {s_cols}")
    if sorted(s_cols) != sorted(d_cols):
        problems.append(f"columns differ: spark={s_cols} oracle={d_cols}")
        return problems
    if len(s_rows) != len(d_rows):
        problems.append(f"row count: spark={len(s_rows)} oracle={len(d_rows)}")
    a, b = _rows(s_cols, s_rows, digits), _rows(d_cols, d_rows, digits)
    if a != b:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        problems.append(f"values differ, e.g. {diff}")
    return problems
