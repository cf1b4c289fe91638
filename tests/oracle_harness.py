"""Run registered queries in Spark and their SQL oracles in DuckDB, compare
row multisets after light normalisation (used by tests and by hand)."""

from __future__ import annotations

import datetime as _dt
import decimal
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from presslens.sources.tables import TABLES  # noqa: E402


def _norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        digits = int(os.environ.get("ORACLE_FLOAT_DIGITS", "-1"))  # -1: exact
        return (round(v, digits) if digits >= 0 else v) + 0.0
    if isinstance(v, _dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, name, fn, sql, sf_dir, con=None):
    con = con or duck(sf_dir)
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    cols = sorted(sdf.columns)
    srows = [tuple(_norm(r[c]) for c in cols) for r in sdf.collect()]
    t1 = time.time()
    rel = con.execute(sql)
    dcols = [d[0] for d in rel.description]
    drows_raw = rel.fetchall()
    t2 = time.time()
    if sorted(dcols) != cols:
        return False, f"columns differ: spark={cols} duck={sorted(dcols)}", t1 - t0
    idx = [dcols.index(c) for c in cols]
    drows = [tuple(_norm(r[i]) for i in idx) for r in drows_raw]
    key = lambda r: repr(r)
    srows.sort(key=key)
    drows.sort(key=key)
    if srows == drows:
        return True, f"{len(srows)} rows", t1 - t0
    diff = [(a, b) for a, b in zip(srows, drows) if a != b][:3]
    return False, f"rows spark={len(srows)} duck={len(drows)}; first diffs: {diff}", t1 - t0


if __name__ == "__main__":
    from presslens import catalog
    from presslens.session import get_spark
    sf = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark = get_spark("local[8]", shuffle_partitions=8)
    qs, ors = catalog.queries(), catalog.oracle_sql()
    names = sys.argv[1:] or sorted(qs)
    con = duck(sf)
    bad = 0
    for n in names:
        if n not in ors:
            df = qs[n](spark, sf)
            print(f"ROWS {n}: {df.count()} rows (no oracle)")
            continue
        try:
            ok, msg, secs = compare(spark, n, qs[n], ors[n], sf, con)
        except Exception as e:  # report and continue
            ok, msg, secs = False, f"ERROR {type(e).__name__}: {str(e)[:800]}", 0
        bad += not ok
        print(f"{'OK  ' if ok else 'FAIL'} {n}: {msg} ({secs:.1f}s)", flush=True)
    print("failures:", bad)
