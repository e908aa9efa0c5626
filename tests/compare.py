"""Rows of a Spark query against DuckDB SQL, whatever their order."""

import os

import duckdb
import numpy as np
import pandas as pd


def _plain(v):
    if isinstance(v, (list, np.ndarray)):
        return str(list(v))
    if v is None or v is pd.NA or (isinstance(v, float) and v != v):
        return None
    if isinstance(v, (bool, np.bool_)):
        return bool(v)
    if isinstance(v, (int, float, np.integer, np.floating)):
        return float(v) + 0.0
    return str(v)


def rows(df):
    df = df[sorted(df)]
    return sorted(tuple(repr(_plain(v)) for v in r) for r in df.itertuples(index=False))


def duck(sql, folder=None, **tables):
    c = duckdb.connect()
    for f in os.listdir(folder) if folder else ():
        c.sql(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{folder}/{f}'")
    for name, t in tables.items():
        c.register(name, t)
    return c.sql(sql).df()
