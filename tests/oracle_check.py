"""Run registered Spark plans and their DuckDB SQL side by side.

    python tests/oracle_check.py /root/testdata/sf0.01 [key,key,...]

Compares row count, column names and an order-insensitive multiset of rows
(floats rounded to 6 places, NaN and infinities kept as text)."""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        if math.isinf(v):
            return "inf" if v > 0 else "-inf"
        return round(v, 6) + 0.0
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def rows_key(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, sf_dir, keys=None, verbose=True):
    import __spark_entry__ as entry
    plans = entry.queries()
    sqls = entry.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for k in keys or list(plans):
        t0 = time.time()
        try:
            sdf = plans[k](spark, sf_dir)
            scols = sdf.columns
            srows = [tuple(r) for r in sdf.collect()]
        except Exception as e:  # pragma: no cover - reported
            results[k] = ("spark-error", repr(e)[:800])
            if verbose:
                print(k, "SPARK ERROR", repr(e)[:800])
            continue
        t1 = time.time()
        if k not in sqls:
            results[k] = ("rows-only", len(srows))
            if verbose:
                print(f"{k}: rows-only {len(srows)} rows ({t1 - t0:.1f}s)")
            continue
        try:
            cur = con.execute(sqls[k])
            dcols = [d[0] for d in cur.description]
            drows = cur.fetchall()
            t2 = time.time()
        except Exception as e:
            results[k] = ("sql-error", repr(e)[:800])
            if verbose:
                print(k, "SQL ERROR", repr(e)[:800])
            continue
        same_cols = sorted(scols) == sorted(dcols)
        a, b = rows_key(scols, srows), rows_key(dcols, drows)
        ok = same_cols and a == b
        results[k] = ("match" if ok else "MISMATCH", len(srows), len(drows))
        if verbose:
            print(f"{k}: {'match' if ok else 'MISMATCH'} spark={len(srows)} duck={len(drows)} "
                  f"cols_ok={same_cols} ({t1 - t0:.1f}s spark, {t2 - t1:.1f}s duck)")
            if not ok:
                if not same_cols:
                    print("   spark cols", scols, "duck cols", dcols)
                only_s = list((a - b).items())[:3]
                only_d = list((b - a).items())[:3]
                print("   only spark:", str(only_s)[:600])
                print("   only duck :", str(only_d)[:600])
    return results


if __name__ == "__main__":
    from lectern.session import local_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    keys = sys.argv[2].split(",") if len(sys.argv) > 2 else None
    spark = local_session(8)
    res = compare(spark, sf, keys)
    bad = [k for k, v in res.items() if v[0] not in ("match", "rows-only")]
    print("NOT OK:", bad)
