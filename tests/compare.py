"""A query's rows against those of its SQL in DuckDB."""

import decimal
import glob
import os

import duckdb
import numpy as np
import pandas as pd


def views(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for p in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM read_parquet('{p}')")
    return con


def rows(df: pd.DataFrame) -> list[tuple]:
    def text(v):
        if v is None or v is pd.NA or v is pd.NaT or isinstance(v, float) and v != v:
            return "~"
        if isinstance(v, (bool, np.bool_)) or not isinstance(v, (int, float, decimal.Decimal, np.number)):
            return str(v)
        return str(int(v)) if v == int(v) else f"{float(v):.9g}"

    return sorted(tuple(text(v) for v in r) for r in df[sorted(df.columns)].itertuples(index=False))
