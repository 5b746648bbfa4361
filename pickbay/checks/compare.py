"""Run registered queries against their DuckDB oracle and compare results.

Usage: python -m pickbay.checks.compare [sf_dir] [key ...]

Comparison: same column names, same row count, and the same multiset of rows
with doubles rounded to 9 significant digits (order-insensitive).
"""

from __future__ import annotations

import datetime as _dt
import decimal
import math
import sys
import time
from collections import Counter

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck_connection(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(f"{v:.9g}")
    if isinstance(v, decimal.Decimal):
        return float(f"{float(v):.9g}")
    if isinstance(v, _dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, _dt.date):
        return v.isoformat()
    return v


def normalise(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(_norm(r[i]) for i in order) for r in rows)


def compare_key(spark, con, sf_dir, key, fn, sql):
    t0 = time.time()
    df = fn(spark, sf_dir)
    s_rows = [tuple(r) for r in df.collect()]
    s_cols = df.columns
    t_spark = time.time() - t0
    rel = con.execute(sql)
    d_cols = [d[0] for d in rel.description]
    d_rows = rel.fetchall()
    sc, sv = normalise(s_cols, s_rows)
    dc, dv = normalise(d_cols, d_rows)
    ok = sc == dc and sv == dv
    detail = ""
    if sc != dc:
        detail = f"columns spark={sc} duck={dc}"
    elif sv != dv:
        only_s = list((sv - dv).elements())[:3]
        only_d = list((dv - sv).elements())[:3]
        detail = f"spark-only {only_s} duck-only {only_d}"
    return ok, len(s_rows), len(d_rows), t_spark, detail


def main(argv):
    sys.path.insert(0, ".")
    from pickbay.checks.oracle import oracle_sql
    from pickbay.registry import queries
    from pickbay.session import get_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    keys = argv[1:]
    spark = get_session("local[8]", shuffle_partitions=8)
    con = duck_connection(sf_dir)
    qs, sqls = queries(), oracle_sql()
    failed = []
    for key in keys or sorted(qs):
        if key not in sqls:
            print(f"{key:32s} no oracle")
            continue
        try:
            ok, ns, nd, t, detail = compare_key(spark, con, sf_dir, key, qs[key], sqls[key])
        except Exception as e:  # report and continue
            ok, ns, nd, t, detail = False, -1, -1, 0.0, f"{type(e).__name__}: {str(e)[:300]}"
        print(f"{key:32s} {'OK ' if ok else 'BAD'} spark={ns} duck={nd} {t:.1f}s {detail}")
        if not ok:
            failed.append(key)
    print("FAILED:", failed)
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
