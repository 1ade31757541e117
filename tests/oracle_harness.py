"""Spark-vs-DuckDB comparison, modelled on the driver's correctness gate.

Usage: python tests/oracle_harness.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders",
          "lineitem", "events", "documents", "embeddings", "pages",
          "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return float(f"{v:.9g}")
    if isinstance(v, decimal.Decimal):
        return float(f"{float(v):.9g}")
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x)) for k, x in v.items()))
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, bool):
        return int(v)
    return v


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr)


def compare(spark, con, name, qfn, sql, sf_dir):
    t0 = time.time()
    sdf = qfn(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    scols = [c.lower() for c in sdf.columns]
    t1 = time.time()
    res = con.execute(sql)
    dcols = [d[0].lower() for d in res.description]
    drows = res.fetchall()
    ok_cols = sorted(scols) == sorted(dcols)
    ok_n = len(srows) == len(drows)
    a, b = canon(scols, srows), canon(dcols, drows)
    ok_v = ok_cols and a == b
    status = "OK " if (ok_cols and ok_n and ok_v) else "BAD"
    print(f"{status} {name}: spark {len(srows)} rows {t1-t0:.1f}s, duck {len(drows)}"
          f"{'' if ok_cols else f' cols {sorted(scols)} vs {sorted(dcols)}'}", flush=True)
    if status == "BAD" and ok_cols:
        sa, sb = set(a), set(b)
        print("   spark-only:", list(sa - sb)[:4])
        print("   duck-only: ", list(sb - sa)[:4])
    return status == "OK "


def main():
    import __spark_entry__ as ent
    from estatelens.session import get_session
    args = sys.argv[1:]
    sf_dir = "/root/testdata/sf0.01"
    if args and args[0].startswith("/"):
        sf_dir, args = args[0], args[1:]
    spark = get_session("local[8]")
    con = duck(sf_dir)
    qs, sqls = ent.queries(), ent.oracle_sql()
    names = args or list(qs)
    bad = []
    for n in names:
        if n not in sqls:
            df = qs[n](spark, sf_dir)
            print(f"--- {n}: no oracle, {df.count()} rows")
            continue
        try:
            if not compare(spark, con, n, qs[n], sqls[n], sf_dir):
                bad.append(n)
        except Exception as e:  # report and continue
            print(f"ERR {n}: {type(e).__name__}: {str(e)[:600]}")
            bad.append(n)
    print("FAILED:", bad)


if __name__ == "__main__":
    main()
