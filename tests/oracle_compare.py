"""Run a registered Spark query and its DuckDB oracle, and compare results
(row count, column names and types, order-insensitive values)."""

from __future__ import annotations

import datetime as dt
import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


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
        return v  # exact: both engines compute the same IEEE operations
    if isinstance(v, dt.datetime):
        return v.date().isoformat() if v.time() == dt.time(0) else v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


SPARK_TO_DUCK = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "date": "DATE",
    "string": "VARCHAR", "boolean": "BOOLEAN", "float": "FLOAT",
}


def compare(spark, con, fn, sql: str | None, sf_dir: str) -> dict:
    df = fn(spark, sf_dir)
    s_cols = df.columns
    s_types = [SPARK_TO_DUCK.get(t, t) for _, t in df.dtypes]
    s_rows = [tuple(r) for r in df.collect()]
    res = {"rows_spark": len(s_rows)}
    if sql is None:
        return res
    rel = con.sql(sql)
    d_cols = rel.columns
    d_types = [str(t) for t in rel.types]
    d_rows = rel.fetchall()
    res["rows_oracle"] = len(d_rows)
    res["cols_match"] = sorted(s_cols) == sorted(d_cols)
    st = dict(zip(s_cols, s_types))
    dt_ = dict(zip(d_cols, d_types))
    res["type_diffs"] = {c: (st[c], dt_.get(c)) for c in s_cols if st[c] != dt_.get(c)}
    res["values_match"] = res["cols_match"] and _rows(s_cols, s_rows) == _rows(d_cols, d_rows)
    res["ok"] = (res["values_match"] and not res["type_diffs"]
                 and res["rows_oracle"] == res["rows_spark"])
    if not res["cols_match"]:
        res["only_spark"] = sorted(set(s_cols) - set(d_cols))[:10]
        res["only_oracle"] = sorted(set(d_cols) - set(s_cols))[:10]
    return res
