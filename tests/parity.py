"""Run registered Spark queries against their DuckDB oracles and compare
row count, column names and an order-insensitive hash of the values.

    python tests/parity.py [sf_dir] [name ...]
"""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return f"{round(v, 6):.6f}"
    if isinstance(v, bool):
        return str(v)
    if hasattr(v, "item"):
        return _norm(v.item())
    return str(v)


def digest(columns, rows) -> str:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("\x1f".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode("utf-8")).hexdigest()


def compare(spark, con, sf_dir, name, fn, sql):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_rows = [tuple(r) for r in sdf.collect()]
    s_cols = sdf.columns
    t1 = time.time()
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    t2 = time.time()
    ok_cols = sorted(s_cols) == sorted(d_cols)
    ok_n = len(s_rows) == len(d_rows)
    ok_h = ok_cols and digest(s_cols, s_rows) == digest(d_cols, d_rows)
    return dict(name=name, cols=ok_cols, count=ok_n, hash=ok_h, spark_rows=len(s_rows), duck_rows=len(d_rows),
                spark_s=round(t1 - t0, 2), duck_s=round(t2 - t1, 2), s_cols=s_cols, d_cols=d_cols,
                s_rows=s_rows, d_rows=d_rows)


def first_difference(r):
    sc, dc = r["s_cols"], r["d_cols"]
    so = sorted(range(len(sc)), key=lambda i: sc[i])
    do = sorted(range(len(dc)), key=lambda i: dc[i])
    s = sorted(tuple(_norm(x[i]) for i in so) for x in r["s_rows"])
    d = sorted(tuple(_norm(x[i]) for i in do) for x in r["d_rows"])
    ss, ds = set(s), set(d)
    only_s = [x for x in s if x not in ds][:2]
    only_d = [x for x in d if x not in ss][:2]
    return only_s, only_d


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and "/" in argv[1] else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if "/" not in a]
    import __spark_entry__ as entry
    from sifter.session import local_session

    spark = local_session()
    con = duck(sf_dir)
    qs, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in names or list(qs):
        if name not in sqls:
            print(f"{name:24s} (no oracle)")
            continue
        try:
            r = compare(spark, con, sf_dir, name, qs[name], sqls[name])
        except Exception as e:  # noqa: BLE001
            bad += 1
            print(f"{name:24s} ERROR {type(e).__name__}: {str(e)[:400]}")
            continue
        ok = r["cols"] and r["count"] and r["hash"]
        bad += not ok
        print(f"{name:24s} {'OK ' if ok else 'BAD'} rows {r['spark_rows']}/{r['duck_rows']} "
              f"cols={r['cols']} hash={r['hash']} spark {r['spark_s']}s duck {r['duck_s']}s")
        if not ok:
            if not r["cols"]:
                print("   spark cols", r["s_cols"], "\n   duck cols ", r["d_cols"])
            else:
                s, d = first_difference(r)
                print("   only spark:", [tuple(str(v)[:160] for v in x) for x in s])
                print("   only duck: ", [tuple(str(v)[:160] for v in x) for x in d])
    print("mismatches:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
