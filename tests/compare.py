"""Compare registered queries with their DuckDB oracles: ``python tests/compare.py [sf] [names]``."""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def duck(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[:-len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def tidy(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if str(df[c].dtype).startswith("datetime64"):
            df[c] = df[c].astype("datetime64[us]")
        elif df[c].dtype == object:
            df[c] = df[c].map(lambda v: None if v is None or v is pd.NaT or v != v else v)
    return df.sort_values(list(df.columns), na_position="first").reset_index(drop=True)


def differences(ours: pd.DataFrame, theirs: pd.DataFrame) -> str:
    """Empty when equal; else a short account of what differs."""
    if sorted(ours.columns) != sorted(theirs.columns):
        return f"columns {sorted(ours.columns)} vs {sorted(theirs.columns)}"
    if len(ours) != len(theirs):
        return f"rows {len(ours)} vs {len(theirs)}"
    a, b = tidy(ours), tidy(theirs)
    notes = []
    for c in a.columns:
        unlike = ~((a[c] == b[c]) | (a[c].isna() & b[c].isna()))
        if unlike.any():
            i = unlike.idxmax()
            notes.append(f"{c}: {int(unlike.sum())} differ, e.g. row {i}: {a[c][i]!r} vs {b[c][i]!r}")
        kinds = {str(a[c].dtype), str(b[c].dtype)}
        if len(kinds) > 1 and not (a[c].isna().all() and b[c].isna().all()):
            notes.append(f"{c}: types {a[c].dtype} vs {b[c].dtype}")
    return "; ".join(notes)


def main() -> None:
    from __spark_entry__ import oracle_sql, queries
    from millwatch.session import get_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    wanted = sys.argv[2:]
    sf_dir = f"/root/testdata/sf{sf}"
    spark = get_session(master="local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, oracle = duck(sf_dir), oracle_sql()
    bad = []
    for name, fn in queries().items():
        if wanted and name not in wanted:
            continue
        t = time.time()
        try:
            ours = fn(spark, sf_dir).toPandas()
            took = time.time() - t
            if name not in oracle:
                print(f"{name:28s} rows {len(ours):8d} {took:6.1f}s  (no oracle)", flush=True)
                continue
            note = differences(ours, con.execute(oracle[name]).df())
        except Exception as error:  # report and go on with the next query
            note, took, ours = f"{type(error).__name__}: {str(error)[:700]}", time.time() - t, []
        print(f"{name:28s} rows {len(ours):8d} {took:6.1f}s  {'ok' if not note else 'FAIL ' + note}", flush=True)
        if note:
            bad.append(name)
    print("failed:", bad)


if __name__ == "__main__":
    main()
