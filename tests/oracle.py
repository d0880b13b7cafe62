"""Spark-vs-DuckDB comparison used by the tests (mirrors the driver's correctness gate)."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

from tidemark.sources.fixtures import BASE_TABLES


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in BASE_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (bytes, bytearray)):
        return bytes(v).hex()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr), [columns[i] for i in order]


def compare(spark_df, con, sql):
    s_rows, s_cols = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows, d_cols = rows_of(d_cols, res.fetchall())
    problems = []
    if s_cols != d_cols:
        problems.append(f"columns differ: spark={s_cols} duckdb={d_cols}")
    if len(s_rows) != len(d_rows):
        problems.append(f"row counts differ: spark={len(s_rows)} duckdb={len(d_rows)}")
    if not problems and s_rows != d_rows:
        diff = [(a, b) for a, b in zip(s_rows, d_rows) if a != b][:3]
        problems.append(f"values differ, first: {diff}")
    return problems, len(s_rows)
