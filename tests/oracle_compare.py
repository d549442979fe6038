"""Compare a Spark result with a DuckDB oracle the way the correctness gate does:
same column names, same row count, same multiset of rows (column order ignored)."""

from __future__ import annotations

import math

import duckdb
import pandas as pd

from tidepool.sources.tables import TABLES

ROUND = False   # exact float equality, as a value hash sees it


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
        return round(v, 6) if ROUND else v
    if hasattr(v, "item"):
        return _norm(v.item())
    try:
        if pd.isna(v):
            return None
    except (TypeError, ValueError):
        pass
    return v


def rows_of(pdf: pd.DataFrame) -> list[tuple]:
    cols = sorted(pdf.columns)
    out = [tuple(_norm(v) for v in rec) for rec in pdf[cols].itertuples(index=False, name=None)]
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def compare(spark_df, con, sql: str) -> tuple[bool, str]:
    s = spark_df.toPandas()
    o = con.execute(sql).fetchdf()
    if sorted(s.columns) != sorted(o.columns):
        return False, f"columns differ: {sorted(s.columns)} vs {sorted(o.columns)}"
    if len(s) != len(o):
        return False, f"row count {len(s)} vs {len(o)}"
    rs, ro = rows_of(s), rows_of(o)
    for a, b in zip(rs, ro):
        if a != b:
            return False, f"first differing row: {a} vs {b}"
    return True, f"{len(s)} rows"
