"""Run registered queries on Spark and their DuckDB twins on the same parquet tables and
compare row count, column names and an order-insensitive hash of the values.

Usage: python tests/oracle_compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return _norm(v.asDict())
    return v


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    out.sort(key=repr)
    return [cols[i] for i in order], out


def digest(rows) -> str:
    h = hashlib.sha256()
    for r in rows:
        h.update(repr(r).encode())
    return h.hexdigest()[:16]


def compare(spark, sf_dir, names=None, verbose=True):
    from __spark_entry__ import oracle_sql, queries
    qs, sqls = queries(), oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name in names or list(qs):
        t0 = time.time()
        try:
            sdf = qs[name](spark, sf_dir)
            scols = sdf.columns
            srows = [tuple(r) for r in sdf.collect()]
        except Exception as e:  # noqa: BLE001
            results[name] = ("spark-error", repr(e)[:400])
            if verbose:
                print(f"{name:28s} SPARK ERROR {e!r}"[:600])
            continue
        ts = time.time() - t0
        if name not in sqls:
            results[name] = ("rows-only", len(srows))
            if verbose:
                print(f"{name:28s} rows-only {len(srows)} rows  spark {ts:.1f}s")
            continue
        try:
            rel = con.execute(sqls[name])
            dcols = [d[0] for d in rel.description]
            drows = rel.fetchall()
        except Exception as e:  # noqa: BLE001
            results[name] = ("duck-error", repr(e)[:400])
            if verbose:
                print(f"{name:28s} DUCKDB ERROR {e!r}"[:600])
            continue
        sc, sr = canon(scols, srows)
        dc, dr = canon(dcols, drows)
        ok = sc == dc and len(sr) == len(dr) and digest(sr) == digest(dr)
        results[name] = ("match" if ok else "MISMATCH", len(sr), len(dr))
        if verbose:
            print(f"{name:28s} {'match' if ok else 'MISMATCH'}  spark={len(sr)} duck={len(dr)} rows  spark {ts:.1f}s")
            if not ok:
                if sc != dc:
                    print("   cols spark:", sc, "\n   cols duck: ", dc)
                else:
                    a, b = set(sr), set(dr)
                    print("   only spark:", list(a - b)[:3])
                    print("   only duck: ", list(b - a)[:3])
    return results


if __name__ == "__main__":
    from parcelflow.session import local_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    spark = local_session(8)
    res = compare(spark, sf, names)
    bad = [k for k, v in res.items() if v[0] not in ("match", "rows-only")]
    print("BAD:", bad)
