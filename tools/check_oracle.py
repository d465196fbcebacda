"""Run registered Spark queries and their DuckDB oracle SQL side by side.

Usage: python tools/check_oracle.py [sf_dir] [key ...]
Prints one line per key: OK / MISMATCH / ERROR with details.
"""

from __future__ import annotations

import math
import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402
import pandas as pd  # noqa: E402

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 5)
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            return _norm(v.item())
        except Exception:
            pass
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime()
    if type(v).__name__ == "date":
        import datetime as _dt
        return _dt.datetime(v.year, v.month, v.day)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(pdf: pd.DataFrame):
    cols = sorted(pdf.columns)
    out = []
    for rec in pdf[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(x) for x in rec))
    return cols, sorted(out, key=lambda r: tuple((x is None, str(type(x)), str(x)) for x in r))


def compare(spdf: pd.DataFrame, dpdf: pd.DataFrame) -> str | None:
    """None when equal (columns, row count, values after rounding), else a reason."""
    sc, sr = _rows(spdf)
    dc, dr = _rows(dpdf)
    if sc != dc:
        return f"columns {sc} vs {dc}"
    if len(sr) != len(dr):
        return f"rows {len(sr)} vs {len(dr)}"
    diffs = [(a, b) for a, b in zip(sr, dr) if a != b]
    if diffs:
        return f"{len(diffs)} rows differ, first {diffs[0]}"
    return None


def main():
    args = sys.argv[1:]
    sf_dir = args[0] if args and os.path.isdir(args[0]) else "/root/testdata/sf0.01"
    keys = [a for a in args if not os.path.isdir(a)]
    from wattlake.session import get_session
    from wattlake.plans.registry import queries, oracle_sql
    spark = get_session("local[8]", shuffle_partitions=8)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    qs, os_ = queries(), oracle_sql()
    keys = keys or list(qs)
    n_ok = n_bad = 0
    for k in keys:
        t0 = time.time()
        try:
            sdf = qs[k](spark, sf_dir)
            spdf = sdf.toPandas()
            dt_spark = time.time() - t0
            if k not in os_:
                print(f"ROWS   {k}: {len(spdf)} rows ({dt_spark:.1f}s)", flush=True)
                continue
            dpdf = con.execute(os_[k]).df()
            sc, sr = _rows(spdf)
            dc, dr = _rows(dpdf)
            if sc != dc:
                n_bad += 1
                print(f"MISMATCH {k}: columns {sc} vs {dc}", flush=True)
                continue
            if len(sr) != len(dr):
                n_bad += 1
                print(f"MISMATCH {k}: rows {len(sr)} vs {len(dr)}", flush=True)
                continue
            diffs = [(a, b) for a, b in zip(sr, dr) if a != b]
            stypes = dict(zip(sdf.columns, [f.dataType.simpleString() for f in sdf.schema]))
            dtypes = {c: str(t) for c, t in zip(dpdf.columns, dpdf.dtypes)}
            if diffs:
                n_bad += 1
                print(f"MISMATCH {k}: {len(diffs)} rows differ, first {diffs[0]}", flush=True)
            else:
                n_ok += 1
                print(f"OK     {k}: {len(sr)} rows ({dt_spark:.1f}s) types spark={stypes} duck={dtypes}",
                      flush=True)
        except Exception as e:  # noqa: BLE001
            n_bad += 1
            print(f"ERROR  {k}: {type(e).__name__}: {str(e)[:400]}", flush=True)
            traceback.print_exc(limit=3)
    print(f"summary ok={n_ok} bad={n_bad}")


if __name__ == "__main__":
    main()
