"""Run a Spark query and its DuckDB oracle on the same parquet tables; compare."""

from __future__ import annotations

import math

import duckdb
import pandas as pd

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 9)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def rows(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    out = [tuple(_norm(x) for x in r) for r in df[cols].itertuples(index=False, name=None)]
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


def compare(spark_df, con, sql: str) -> tuple[bool, str]:
    s = spark_df.toPandas()
    d = con.execute(sql).df()
    if sorted(s.columns) != sorted(d.columns):
        return False, f"columns differ: spark={sorted(s.columns)} duck={sorted(d.columns)}"
    if len(s) != len(d):
        return False, f"row counts differ: spark={len(s)} duck={len(d)}"
    rs, rd = rows(s), rows(d)
    for a, b in zip(rs, rd):
        if a != b:
            return False, f"first diff: spark={a} duck={b}"
    return True, f"{len(s)} rows equal"
