"""Run registered queries in Spark and their oracle SQL in DuckDB and compare
(row count, column names, order-insensitive values with doubles rounded).

Usage: python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        p = Path(sf_dir) / f"{t}.parquet"
        if p.exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v, digits=6):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(f"{v:.{digits}g}")
    if hasattr(v, "isoformat"):
        return v.replace(tzinfo=None).isoformat() if getattr(v, "tzinfo", None) else v.isoformat()
    return v


def normalise(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=repr)


def _close(scols, srows, dcols, drows, rel_tol=1e-12):
    """Rows paired by the 6-digit sort key must also agree to ``rel_tol``."""
    order_s = sorted(range(len(scols)), key=lambda i: scols[i])
    order_d = sorted(range(len(dcols)), key=lambda i: dcols[i])
    key = lambda r: repr(tuple(_norm(v) for v in r))
    a = sorted((tuple(r[i] for i in order_s) for r in srows), key=key)
    b = sorted((tuple(r[i] for i in order_d) for r in drows), key=key)
    for x_row, y_row in zip(a, b):
        for x, y in zip(x_row, y_row):
            if isinstance(x, float) and isinstance(y, float):
                if not (x == y or (x != x and y != y) or math.isclose(x, y, rel_tol=rel_tol, abs_tol=1e-300)):
                    return False
    return True


def compare(spark, con, name, query, sql, sf_dir):
    t0 = time.time()
    sdf = query(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    scols, s = normalise(sdf.columns, srows)
    dcols, d = normalise(dcols, drows)
    ok = scols == dcols and s == d and _close(sdf.columns, srows, [d[0] for d in res.description], drows)
    detail = ""
    if scols != dcols:
        detail = f"cols spark={scols} duck={dcols}"
    elif len(s) != len(d):
        detail = f"rows spark={len(s)} duck={len(d)}"
    elif s != d:
        only_s = [r for r in s if r not in set(d)][:2]
        only_d = [r for r in d if r not in set(s)][:2]
        detail = f"values differ: spark-only {only_s} duck-only {only_d}"
    return ok, len(srows), t1 - t0, detail


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    only = set(argv[2:])
    from __spark_entry__ import oracle_sql, queries

    from aerolith.session import build_session

    spark = build_session(master="local[8]", shuffle_partitions=8)
    con = duck(sf_dir)
    qs, oracle = queries(), oracle_sql()
    failures = 0
    for name, fn in qs.items():
        if only and name not in only:
            continue
        if name not in oracle:
            rows = fn(spark, sf_dir).count()
            print(f"NO-ORACLE {name}: rows={rows}")
            continue
        try:
            ok, n, secs, detail = compare(spark, con, name, fn, oracle[name], sf_dir)
        except Exception as exc:  # report and continue
            ok, n, secs, detail = False, -1, 0.0, f"{type(exc).__name__}: {str(exc)[:400]}"
        failures += not ok
        print(f"{'OK ' if ok else 'BAD'} {name}: rows={n} {secs:.1f}s {detail}")
    print(f"failures={failures}")
    return failures


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
