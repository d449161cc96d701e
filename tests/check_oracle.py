"""Compare registered queries with their SQL in DuckDB.

    python tests/check_oracle.py [--sf 0.01] [name ...]
"""

from __future__ import annotations

import argparse
import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
import __spark_entry__ as entry_point  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(folder: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def normal(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if pd.api.types.is_bool_dtype(df[c]):
            df[c] = df[c].astype(int)
        if pd.api.types.is_numeric_dtype(df[c]):
            df[c] = df[c].astype(float)
        else:
            df[c] = df[c].astype(str)
    return df.sort_values(list(df.columns)).reset_index(drop=True)


def difference(got: pd.DataFrame, want: pd.DataFrame) -> str | None:
    """Why two results differ, or None; values must be equal."""
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    a, b = normal(got), normal(want)
    for c in a.columns:
        if a[c].dtype != b[c].dtype:
            return f"type of {c}: {a[c].dtype} != {b[c].dtype}"
        same = (a[c] == b[c]) | (a[c].isna() & b[c].isna())
        if not same.all():
            i = same.idxmin()
            return f"{(~same).sum()} values of {c}, first {a[c][i]!r} != {b[c][i]!r}"
    return None


def main() -> int:
    from millrace.session import build_session

    args = argparse.ArgumentParser()
    args.add_argument("--sf", default="0.01")
    args.add_argument("names", nargs="*")
    args = args.parse_args()
    folder = f"/root/testdata/sf{args.sf}"
    spark = build_session(master="local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="12g", spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    queries, oracle = entry_point.queries(), entry_point.oracle_sql()
    con, bad = connect(folder), 0
    for name in args.names or queries:
        try:
            start = time.time()
            got = queries[name](spark, folder).toPandas()
            spent = time.time() - start
            if name not in oracle:
                print(f"rows-only {name}: {len(got)} rows {spent:.1f}s", flush=True)
                continue
            start = time.time()
            want = con.execute(oracle[name]).fetchdf()
            why = difference(got, want)
        except Exception as e:  # report and go on with the next query
            why, spent, got = f"{type(e).__name__}: {str(e)[:600]}", time.time() - start, []
        bad += why is not None
        print(f"{'ok ' if why is None else 'BAD'} {name}: {len(got)} rows spark {spent:.1f}s {why or ''}", flush=True)
    print("failures:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
