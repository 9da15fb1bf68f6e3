"""Runs a query in Spark and its check in DuckDB and compares the results."""

from __future__ import annotations

import glob
import os

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[:-8]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(v):
    if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and v != v):
        return "∅"
    if hasattr(v, "isoformat"):
        return pd.Timestamp(v).tz_localize(None).isoformat()
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        return repr(round(v, 6)) if v != int(v) else str(int(v))
    return str(v)


def rows_of(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    df = df[cols].astype(object)
    return sorted(tuple(_plain(v) for v in r) for r in df.itertuples(index=False))


def compare(spark_df, con, sql: str) -> dict:
    got = spark_df.toPandas()
    rel = con.execute(sql)
    want = rel.df()
    out = {"rows": len(got), "want_rows": len(want)}
    out["columns"] = sorted(got.columns) == sorted(want.columns)
    if not out["columns"]:
        out["diff"] = (sorted(got.columns), sorted(want.columns))
        out["ok"] = False
        return out
    a, b = rows_of(got), rows_of(want)
    out["ok"] = a == b
    if a != b:
        sa, sb = set(a), set(b)
        out["diff"] = {"cols": sorted(got.columns), "spark_only": sorted(sa - sb)[:3], "check_only": sorted(sb - sa)[:3],
                       "n_spark_only": len(sa - sb), "n_check_only": len(sb - sa)}
    return out
