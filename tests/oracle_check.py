"""Run registered Spark queries next to their DuckDB oracle and compare.

Usage: python tests/oracle_check.py [sf_dir] [key ...]
Compares row count, column names and order-insensitive values (floats with a
small relative tolerance).
"""

from __future__ import annotations

import math
import os
import sys
import time
from decimal import Decimal

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


STRICT = os.environ.get("ORACLE_STRICT") == "1"  # exact values, no float rounding


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        if STRICT:
            return v
        return round(v, 6) if abs(v) < 1e12 else float(f"{v:.9g}")
    if isinstance(v, Decimal):
        if STRICT:
            return str(v)
        return _norm(float(v)) if v != v.to_integral_value() or abs(v) < 2**53 else str(v)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((str(k), _norm(x)) for k, x in v.items()))
    if isinstance(v, bool):
        return int(v)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), str(x)) for x in t))


def compare(spark, sf_dir, keys=None, verbose=True):
    import duckdb

    import __spark_entry__ as E

    q, o = E.queries(), E.oracle_sql()
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    results = {}
    for k in keys or list(q):
        t0 = time.time()
        try:
            df = q[k](spark, sf_dir)
            srows = df.collect()
            snames = df.columns
        except Exception as e:  # noqa: BLE001
            results[k] = ("SPARK_ERROR", str(e)[:300])
            if verbose:
                print(k, "SPARK_ERROR", str(e)[:600], flush=True)
            continue
        ts = time.time() - t0
        if k not in o:
            results[k] = ("rows_only", len(srows))
            if verbose:
                print(f"{k:32s} rows_only n={len(srows)} {ts:.1f}s", flush=True)
            continue
        try:
            t1 = time.time()
            cur = con.execute(o[k])
            dnames = [d[0] for d in cur.description]
            drows = cur.fetchall()
            td = time.time() - t1
        except Exception as e:  # noqa: BLE001
            results[k] = ("SQL_ERROR", str(e)[:300])
            if verbose:
                print(k, "SQL_ERROR", str(e)[:600], flush=True)
            continue
        ok_names = sorted(snames) == sorted(dnames)
        ok_count = len(srows) == len(drows)
        a, b = rows_of(snames, srows), rows_of(dnames, drows)
        ok_vals = ok_names and ok_count and a == b
        status = "OK" if ok_vals else "MISMATCH"
        results[k] = (status, len(srows), len(drows))
        if verbose:
            print(f"{k:32s} {status} n={len(srows)}/{len(drows)} names={ok_names} spark={ts:.1f}s duck={td:.1f}s",
                  flush=True)
            if not ok_vals:
                if not ok_names:
                    print("   spark:", sorted(snames), "\n   duck: ", sorted(dnames))
                else:
                    diff_a = [r for r in a if r not in set(b)][:3]
                    diff_b = [r for r in b if r not in set(a)][:3]
                    print("   spark-only:", diff_a, "\n   duck-only: ", diff_b)
    return results


if __name__ == "__main__":
    from ladle.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    keys = sys.argv[2:] or None
    spark = local_session(8)
    res = compare(spark, sf, keys)
    bad = [k for k, v in res.items() if v[0] not in ("OK", "rows_only")]
    print("SUMMARY ok=%d rows_only=%d bad=%d %s" % (sum(v[0] == "OK" for v in res.values()),
                                                    sum(v[0] == "rows_only" for v in res.values()), len(bad), bad))
