"""Order-insensitive comparison of a Spark result with its DuckDB oracle."""

from __future__ import annotations

import decimal
import math
import os

import pandas as pd

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duckdb_views(sf_dir: str):
    """A DuckDB connection with every driver table registered as a view."""
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


EXACT = bool(os.environ.get("ORACLE_EXACT"))


def _norm(v):
    """Numbers compare as floats rounded to 6 places (exactly with
    ORACLE_EXACT=1); NaN / NA / None are NULL."""
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        v = v.item()
    if isinstance(v, bool):
        return v
    if isinstance(v, (int, float, decimal.Decimal)):
        f = float(v)
        return None if math.isnan(f) else (f if EXACT else round(f, 6))
    return v


def rows_of(pdf: pd.DataFrame):
    """(sorted column names, sorted row tuples) of a pandas frame."""
    cols = sorted(pdf.columns)
    out = [tuple(repr(_norm(v)) for v in rec) for rec in pdf[cols].itertuples(index=False, name=None)]
    return cols, sorted(out)
