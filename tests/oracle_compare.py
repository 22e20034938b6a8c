"""Run registered queries in Spark and their SQL in DuckDB; compare results.

Mirrors the driver's gate: row count, column names, and an
order-insensitive comparison of all values (columns sorted by name).
Usable as a script: ``python tests/oracle_compare.py [sf_dir] [name ...]``.
"""

from __future__ import annotations

import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return float(v)
    if isinstance(v, decimal.Decimal):
        return str(v.normalize()) if v == v else None
    if isinstance(v, (bytes, bytearray, memoryview)):
        return bytes(v).hex()
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _key(row):
    return tuple((x is None, str(type(x)), x if x is not None else 0) for x in row)


def rows_of(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in records]
    return [cols[i] for i in order], sorted(out, key=_key)


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t_spark = time.time() - t0
    if sql is None:
        return {"name": name, "ok": None, "rows": len(s_rows), "spark_s": round(t_spark, 2)}
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    sc, sr = rows_of(s_cols, s_rows)
    dc, dr = rows_of(d_cols, d_rows)
    ok = sc == dc and len(sr) == len(dr) and sr == dr
    info = {"name": name, "ok": ok, "rows": len(sr), "oracle_rows": len(dr), "spark_s": round(t_spark, 2)}
    if not ok:
        info["cols"] = (sc, dc)
        diffs = [(a, b) for a, b in zip(sr, dr) if a != b][:3]
        info["diff"] = diffs
    return info


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    import __spark_entry__ as E
    from tessera.session import get_spark

    spark = get_spark()
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        try:
            info = compare(spark, con, name, fn, sqls.get(name), sf_dir)
        except Exception as e:  # report and continue
            info = {"name": name, "ok": False, "error": repr(e)[:800]}
        bad += info.get("ok") is False
        print(info, flush=True)
    print("FAILED" if bad else "ALL OK", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
