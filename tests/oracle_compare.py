"""Run registered queries in Spark and their DuckDB twins; compare rows.

Usage: python tests/oracle_compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, (bytes, bytearray)):
        return bytes(v).hex()
    return v


def _rows(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in records]
    out.sort(key=lambda t: tuple((x is None, str(x)) for x in t))
    return [cols[i] for i in order], out


def duck_connect(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, sf_dir: str, name: str, query, sql: str, con=None) -> tuple[bool, str]:
    con = con or duck_connect(sf_dir)
    t0 = time.time()
    sdf = query(spark, sf_dir)
    s_cols = sdf.columns
    s_rec = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    rel = con.sql(sql)
    d_cols = list(rel.columns)
    d_rec = rel.fetchall()
    t2 = time.time()
    sc, sr = _rows(s_cols, s_rec)
    dc, dr = _rows(d_cols, d_rec)
    if sc != dc:
        return False, f"columns differ: spark={sc} duck={dc}"
    if len(sr) != len(dr):
        return False, f"row count spark={len(sr)} duck={len(dr)}"
    bad = [(a, b) for a, b in zip(sr, dr) if a != b]
    if bad:
        return False, f"{len(bad)} rows differ, e.g. spark={bad[0][0]} duck={bad[0][1]}"
    return True, f"{len(sr)} rows ok (spark {t1 - t0:.1f}s, duck {t2 - t1:.1f}s)"


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    import __spark_entry__ as e
    from trajlake.session import get_session
    spark = get_session()
    q, o = e.queries(), e.oracle_sql()
    con = duck_connect(sf_dir)
    ok_all = True
    for name in names or list(q):
        if name not in o:
            df = q[name](spark, sf_dir)
            print(f"{name}: rows-only {df.count()} rows")
            continue
        try:
            ok, msg = compare(spark, sf_dir, name, q[name], o[name], con)
        except Exception as ex:  # report and continue
            ok, msg = False, f"ERROR {type(ex).__name__}: {str(ex)[:800]}"
        ok_all &= ok
        print(f"{name}: {'OK' if ok else 'FAIL'} {msg}", flush=True)
    return 0 if ok_all else 1


if __name__ == "__main__":
    sys.exit(main(sys.argv))
