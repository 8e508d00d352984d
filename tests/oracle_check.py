"""Run every registered Spark query next to its DuckDB oracle and compare.

    python tests/oracle_check.py /root/testdata/sf0.01 [name ...]

Comparison is strict: same column names, same row count, and the same multiset
of rows after sorting columns by name, with values rendered canonically
(decimals keep their scale, timestamps in ISO form).
"""

from __future__ import annotations

import datetime as dt
import decimal
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def canon(v):
    if v is None:
        return "∅"
    if isinstance(v, bool):
        return "T" if v else "F"
    if isinstance(v, decimal.Decimal):
        return f"D{v}"
    if isinstance(v, float):
        return f"F{v!r}"
    if isinstance(v, dt.datetime):
        return v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return repr(v)


def normalise(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], sorted(tuple(canon(r[i]) for i in order) for r in rows)


def duck(sf_dir):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    cur = con.execute(sql)
    d_cols = [d[0] for d in cur.description]
    d_rows = cur.fetchall()
    t2 = time.time()
    sc, sr = normalise(s_cols, s_rows)
    dc, dr = normalise(d_cols, d_rows)
    ok = sc == dc and sr == dr
    detail = ""
    if sc != dc:
        detail = f"columns spark={sc} duck={dc}"
    elif len(sr) != len(dr):
        detail = f"rows spark={len(sr)} duck={len(dr)}"
    elif sr != dr:
        a, b = set(sr), set(dr)
        only_s = sorted(a - b)[:3]
        only_d = sorted(b - a)[:3]
        detail = f"values differ; spark-only={only_s} duck-only={only_d} cols={sc}"
    return ok, len(sr), t1 - t0, t2 - t1, detail


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    from fleetdw.session import build_session

    import __spark_entry__ as entry
    from fleetdw.checks.oracle_queries import oracle_sql

    spark = build_session("local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    qs, sqls = entry.queries(), entry.oracle_sql() | oracle_sql(sf_dir)
    con = duck(sf_dir)
    bad = 0
    for name in names or list(qs):
        if name not in sqls:
            print(f"{name:28s} NO-ORACLE")
            continue
        try:
            ok, n, ts, td, detail = compare(spark, con, name, qs[name], sqls[name], sf_dir)
        except Exception as exc:  # noqa: BLE001
            ok, n, ts, td, detail = False, -1, 0, 0, f"ERROR {type(exc).__name__}: {str(exc)[:400]}"
        bad += not ok
        print(f"{name:28s} {'OK  ' if ok else 'FAIL'} rows={n:<7d} spark={ts:6.2f}s duck={td:6.2f}s {detail}",
              flush=True)
    print(f"failures: {bad}")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
