"""Run registered queries on Spark and their oracle SQL on DuckDB; compare
row count, column names and order-insensitive values.

    python tools/oracle_check.py [sf_dir] [key ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


STRICT = bool(os.environ.get("ORACLE_STRICT"))


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else (v if STRICT else round(v, 5))
    if isinstance(v, decimal.Decimal):
        return round(float(v), 5)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if hasattr(v, "item"):
        return norm(v.item())
    if isinstance(v, bool):
        return v
    return v


def rows_of(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm(r[i]) for i in order) for r in records]
    return sorted(out, key=repr)


def compare(spark, con, key, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    scols = sdf.columns
    srows = [tuple(r) for r in sdf.collect()]
    ts = time.time() - t0
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    if sorted(scols) != sorted(dcols):
        return False, f"columns differ: spark={sorted(scols)} duck={sorted(dcols)}", ts
    if len(srows) != len(drows):
        return False, f"rows differ: spark={len(srows)} duck={len(drows)}", ts
    a, b = rows_of(scols, srows), rows_of(dcols, drows)
    if a != b:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        return False, f"values differ ({sum(x != y for x, y in zip(a, b))} rows) e.g. {diff}", ts
    return True, f"{len(srows)} rows", ts


def main():
    args = sys.argv[1:]
    sf_dir = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    keys = [a for a in args if not a.startswith("/")]
    from dimstack.session import get_session
    from queries import all_oracles, all_queries
    spark = get_session("oracle-check")
    if os.environ.get("ORACLE_TZ"):      # results must not depend on the session zone
        spark.conf.set("spark.sql.session.timeZone", os.environ["ORACLE_TZ"])
    if os.environ.get("ORACLE_ANSI"):
        spark.conf.set("spark.sql.ansi.enabled", os.environ["ORACLE_ANSI"])
    con = duck(sf_dir)
    qs, os_ = all_queries(), all_oracles()
    bad = rows_only = 0
    for k in keys or list(qs):
        if k not in os_:
            rows_only += 1
            t0 = time.time()
            n = qs[k](spark, sf_dir).count()
            print(f"ROWS  {k:32s} {n} rows (no oracle) {time.time()-t0:.1f}s", flush=True)
            continue
        try:
            ok, msg, ts = compare(spark, con, k, qs[k], os_[k], sf_dir)
        except Exception as e:  # noqa: BLE001
            ok, msg, ts = False, f"ERROR {type(e).__name__}: {str(e)[:400]}", 0.0
        bad += not ok
        print(f"{'OK  ' if ok else 'FAIL'}  {k:32s} {msg} {ts:.1f}s", flush=True)
    print(f"{len(keys or qs) - bad - rows_only} ok, {bad} failing, {rows_only} rows-only")
    sys.exit(1 if bad else 0)


if __name__ == "__main__":
    main()
