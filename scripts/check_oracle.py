"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

usage: python scripts/check_oracle.py [sf_dir] [name ...]
Compares row count, column names and the multiset of rows (columns sorted by
name), as the driver's correctness gate does.
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DRIVER_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                 "events", "documents", "embeddings", "pages", "benchmark", "labels",
                 "conversations"]


def duck(sf_dir):
    import duckdb
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if hasattr(v, "items"):
        return tuple(sorted((k, norm(x)) for k, x in v.items()))
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr)


def compare(spark, con, sf_dir, name, sql):
    from riskpanel.catalog import queries
    t0 = time.time()
    sdf = queries()[name](spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    scols = sdf.columns
    t1 = time.time()
    cur = con.execute(sql)
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    t2 = time.time()
    ok_cols = sorted(scols) == sorted(dcols)
    a, b = canon(scols, srows), canon(dcols, drows)
    ok = ok_cols and len(a) == len(b) and a == b
    detail = ""
    if not ok:
        if not ok_cols:
            detail = f"cols spark={sorted(scols)} duck={sorted(dcols)}"
        elif len(a) != len(b):
            detail = f"rows spark={len(a)} duck={len(b)}"
        else:
            diffs = [(x, y) for x, y in zip(a, b) if x != y]
            detail = f"{len(diffs)} rows differ; first: spark={diffs[0][0]} duck={diffs[0][1]}"
    return ok, len(srows), t1 - t0, t2 - t1, detail


def main():
    args = sys.argv[1:]
    sf_dir = args[0] if args and os.path.isdir(args[0]) else "/root/testdata/sf0.01"
    names = [a for a in args if not os.path.isdir(a)]
    from riskpanel.catalog import oracle_sql, queries
    from riskpanel.session import get_session
    spark = get_session("local[8]", 8)
    con = duck(sf_dir)
    sqls = oracle_sql()
    qs = queries()
    names = names or sorted(qs)
    bad = 0
    for n in names:
        if n not in sqls:
            df = qs[n](spark, sf_dir)
            print(f"ROWS  {n}: {df.count()} rows (no oracle)")
            continue
        try:
            ok, nrows, ts, td, detail = compare(spark, con, sf_dir, n, sqls[n])
        except Exception as e:  # report and go on
            ok, nrows, ts, td, detail = False, -1, 0, 0, f"{type(e).__name__}: {str(e)[:300]}"
        bad += not ok
        print(f"{'OK  ' if ok else 'FAIL'}  {n}: rows={nrows} spark={ts:.2f}s duck={td:.2f}s {detail}")
    print(f"{len(names) - bad}/{len(names)} ok")


if __name__ == "__main__":
    main()
