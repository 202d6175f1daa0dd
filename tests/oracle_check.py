"""Run registered queries against their DuckDB oracle, the way the driver does:
same row count, same column names, equal order-insensitive value hash.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from quaybook.sources.tables import TABLES, table_path  # noqa: E402

FLOAT_DIGITS = 9


def duck_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = table_path(sf_dir, t)
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        if v.is_integer() and abs(v) < 2**53:
            return int(v)
        return round(v, FLOAT_DIGITS)
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            return _norm(v.item())
        except (ValueError, AttributeError):
            pass
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "tolist"):
        return tuple(_norm(x) for x in v.tolist())
    if isinstance(v, pd.Timestamp):
        return v.date().isoformat() if v == v.normalize() else v.isoformat()
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def frame_digest(pdf: pd.DataFrame) -> tuple[int, list[str], str]:
    cols = sorted(pdf.columns)
    rows = []
    for rec in pdf[cols].itertuples(index=False, name=None):
        rows.append(repr(tuple(_norm(v) for v in rec)))
    rows.sort()
    h = hashlib.sha256("\n".join(rows).encode()).hexdigest()
    return len(pdf), cols, h


def compare(spark, name, fn, sql, sf_dir, con) -> dict:
    t0 = time.time()
    spdf = fn(spark, sf_dir).toPandas()
    t1 = time.time()
    ddf = con.execute(sql).df()
    a, b = frame_digest(spdf), frame_digest(ddf)
    out = {"name": name, "rows": a[0], "oracle_rows": b[0], "cols_equal": a[1] == b[1],
           "hash_equal": a[2] == b[2], "spark_sec": round(t1 - t0, 2)}
    if a[1] != b[1]:
        out["cols"] = (a[1], b[1])
    out["ok"] = a[0] == b[0] and a[1] == b[1] and a[2] == b[2]
    if not out["ok"] and a[1] == b[1]:
        cols = a[1]
        sa = {repr(tuple(_norm(v) for v in r)) for r in spdf[cols].itertuples(index=False, name=None)}
        sb = {repr(tuple(_norm(v) for v in r)) for r in ddf[cols].itertuples(index=False, name=None)}
        out["only_spark"] = sorted(sa - sb)[:3]
        out["only_oracle"] = sorted(sb - sa)[:3]
    return out


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    import __spark_entry__ as E
    from quaybook.session import local_session
    spark = local_session()
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck_connection(sf_dir)
    bad = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        if name not in sqls:
            n = fn(spark, sf_dir).count()
            print(f"{name}: rows-only {n}")
            continue
        r = compare(spark, name, fn, sqls[name], sf_dir, con)
        bad += not r["ok"]
        print(r if not r["ok"] else f"{name}: OK rows={r['rows']} {r['spark_sec']}s", flush=True)
    print("mismatches:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
