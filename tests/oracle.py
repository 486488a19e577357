"""Compare a query with its SQL, as the driver does: columns by name, rows in any order."""

import os

import duckdb
import numpy as np
import pandas as pd


def connect(sf):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in os.listdir(sf):
        con.execute(f"CREATE VIEW {t.split('.')[0]} AS SELECT * FROM '{sf}/{t}'")
    return con


def normal(df):
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if df[c].dtype == object or str(df[c].dtype) in ("str", "string"):
            df[c] = df[c].map(lambda x: None if x is None or (isinstance(x, float) and np.isnan(x)) else str(x))
        else:
            df[c] = pd.to_numeric(df[c]).astype(float)
    return df.sort_values(list(df.columns), kind="stable").reset_index(drop=True)


def assert_same(got, want):
    a, b = normal(got), normal(want)
    assert list(a.columns) == list(b.columns)
    assert len(a) == len(b)
    for c in a.columns:
        same = (a[c] == b[c]) | (a[c].isna() & b[c].isna())
        assert same.all(), (c, a[c][~same].head(3).tolist(), b[c][~same].head(3).tolist())
