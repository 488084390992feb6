"""Spark's rows against DuckDB's."""

from __future__ import annotations

import glob
import os

import duckdb
import pandas as pd

SMALL = "/root/testdata/sf0.001"


def database(sf_dir: str = SMALL):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for f in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return con


def rows(df: pd.DataFrame) -> list[str]:
    def plain(x):
        if x is None or x is pd.NaT or x is pd.NA or (isinstance(x, float) and x != x):
            return None
        if hasattr(x, "dtype"):
            return float(x) if x.dtype.kind == "f" else int(x) if x.dtype.kind in "iu" else x
        return x

    df = df[sorted(df.columns)]
    return sorted(repr(tuple(map(plain, r))) for r in df.itertuples(index=False))


def same(spark_df, con, sql: str) -> None:
    mine, theirs = spark_df.toPandas(), con.execute(sql).df()
    for name, kind in spark_df.dtypes:  # pandas has no null among plain integers
        if kind in ("int", "bigint") and str(theirs[name].dtype).startswith("Int"):
            mine[name] = mine[name].astype("Int64")
    assert sorted(mine.columns) == sorted(theirs.columns)
    assert rows(mine) == rows(theirs)
