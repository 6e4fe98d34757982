"""Spark query vs DuckDB oracle: row count, column names, order-insensitive values.

Usage: python tests/oracle_harness.py [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _key(row):
    return tuple((x is None, str(type(x)), x if x is not None else 0) for x in row)


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cols = [columns[i] for i in order]
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    out.sort(key=lambda r: tuple((x is None, str(x)) for x in r))
    return cols, out


def compare(spark, name, query, sql, sf_dir, con):
    t0 = time.time()
    df = query(spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    spark_cols = df.columns
    elapsed = time.time() - t0
    if sql is None:
        return {"query": name, "rows": len(rows), "status": "rows-only", "sec": elapsed}
    res = con.execute(sql)
    duck_cols = [d[0] for d in res.description]
    duck_rows = res.fetchall()
    sc, sr = canonical(spark_cols, rows)
    dc, dr = canonical(duck_cols, duck_rows)
    status = "ok"
    detail = ""
    if sc != dc:
        status, detail = "columns", f"spark={sc} duck={dc}"
    elif len(sr) != len(dr):
        status, detail = "rowcount", f"spark={len(sr)} duck={len(dr)}"
    elif sr != dr:
        diff = [(a, b) for a, b in zip(sr, dr) if a != b][:3]
        status, detail = "values", str(diff)
    return {"query": name, "rows": len(rows), "status": status, "detail": detail,
            "sec": round(elapsed, 2)}


def main(argv):
    import __spark_entry__ as entry
    from strata.session import build_session
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    wanted = argv[2:]
    spark = build_session()
    con = duck(sf_dir)
    qs, oracle = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if wanted and name not in wanted:
            continue
        try:
            r = compare(spark, name, fn, oracle.get(name), sf_dir, con)
        except Exception as exc:  # report and keep going
            r = {"query": name, "status": "error", "detail": repr(exc)[:400]}
        bad += r["status"] not in ("ok", "rows-only")
        print(r, flush=True)
    print(f"FAILED {bad}" if bad else "ALL OK")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
