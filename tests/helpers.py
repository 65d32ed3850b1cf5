"""Cross-engine comparison used by the tests (mirrors tools/check_oracle.py)."""

import duckdb
import numpy as np
import pandas as pd

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if pd.api.types.is_datetime64_any_dtype(df[c]):
            df[c] = df[c].astype("datetime64[us]").astype("int64")
    return df.sort_values(list(df.columns), na_position="first", kind="mergesort") \
        .reset_index(drop=True)


def assert_same(a: pd.DataFrame, b: pd.DataFrame, tol: float = 0.0):
    assert sorted(a.columns) == sorted(b.columns), (sorted(a.columns), sorted(b.columns))
    assert len(a) == len(b), (len(a), len(b))
    a, b = _norm(a), _norm(b)
    for c in a.columns:
        x, y = a[c], b[c]
        if pd.api.types.is_numeric_dtype(x) and pd.api.types.is_numeric_dtype(y):
            xv, yv = x.astype(float).to_numpy(), y.astype(float).to_numpy()
            assert (np.isnan(xv) == np.isnan(yv)).all(), f"nulls differ in {c}"
            m = ~np.isnan(xv)
            assert np.allclose(xv[m], yv[m], rtol=0, atol=tol), f"values differ in {c}"
        else:
            assert (x.astype(str).to_numpy() == y.astype(str).to_numpy()).all(), f"{c} differs"
