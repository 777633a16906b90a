"""Rows of a Spark result and of DuckDB in one comparable form."""

import glob
import os

import duckdb
import numpy as np


def canon(x):
    if x is None or isinstance(x, float) and x != x:
        return None
    if isinstance(x, float):
        return round(x, 6) + 0.0
    if isinstance(x, (list, tuple, np.ndarray)):
        return tuple(canon(y) for y in x)
    if isinstance(x, dict):
        return tuple((k, canon(v)) for k, v in sorted(x.items()))
    if hasattr(x, "asDict"):
        return canon(x.asDict())
    if isinstance(x, np.generic):
        return canon(x.item())
    return None if str(x) in ("NaT", "<NA>") else x


def rows(frame):
    columns = sorted(frame.columns)
    return columns, sorted(repr(tuple(canon(v) for v in r)) for r in frame[columns].itertuples(index=False, name=None))


def connect(folder):
    con = duckdb.connect()
    for f in glob.glob(f"{folder}/*.parquet"):
        con.execute(f"create view {os.path.basename(f)[:-8]} as select * from read_parquet('{f}')")
    return con
