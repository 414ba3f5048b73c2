"""Run registered queries in Spark and their SQL twins in DuckDB; compare.

Usage: python tools/oracle_check.py [sf_dir] [name ...]

Comparison mirrors the driver's: column names sorted, row count, schema
(type family per column) and an order-insensitive multiset of row values.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir):
    import duckdb
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"create view {t} as select * from read_parquet('{p}')")
    return con


def canon(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v + 0.0
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, (dt.datetime,)):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(canon(x) for x in v)
    if hasattr(v, "item"):
        return canon(v.item())
    return v


def family(t: str) -> str:
    t = t.lower()
    for k, fam in (("bigint", "int"), ("long", "int"), ("int", "int"), ("hugeint", "int"),
                   ("double", "float"), ("float", "float"), ("decimal", "float"),
                   ("varchar", "str"), ("string", "str"), ("timestamp", "ts"),
                   ("date", "date"), ("bool", "bool"), ("array", "list"), ("[]", "list")):
        if k in t:
            return fam
    return t


def rows_of(cols, tuples):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(canon(r[i]) for i in order) for r in tuples), key=repr)


def check(spark, sf_dir, names=None, verbose=True):
    from tidemark.plans.catalog import ORACLE, QUERIES
    con = duck(sf_dir)
    results = {}
    for name, fn in QUERIES.items():
        if names and name not in names:
            continue
        t0 = time.time()
        try:
            sdf = fn(spark, sf_dir)
            s_cols = sdf.columns
            s_types = {f.name: family(f.dataType.simpleString()) for f in sdf.schema.fields}
            s_rows = [tuple(r) for r in sdf.collect()]
        except Exception as e:  # noqa: BLE001
            results[name] = ("SPARK-ERROR", repr(e)[:400])
            if verbose:
                print(f"{name:32s} SPARK-ERROR {repr(e)[:400]}")
            continue
        t_spark = time.time() - t0
        sql = ORACLE.get(name)
        if sql is None:
            results[name] = ("rows-only", len(s_rows))
            if verbose:
                print(f"{name:32s} rows-only n={len(s_rows)} ({t_spark:.1f}s)")
            continue
        try:
            rel = con.sql(sql)
            d_cols = rel.columns
            d_types = {c: family(str(t)) for c, t in zip(rel.columns, rel.types)}
            d_rows = rel.fetchall()
        except Exception as e:  # noqa: BLE001
            results[name] = ("SQL-ERROR", repr(e)[:400])
            if verbose:
                print(f"{name:32s} SQL-ERROR {repr(e)[:400]}")
            continue
        ok_cols = sorted(s_cols) == sorted(d_cols)
        ok_types = ok_cols and all(s_types[c] == d_types[c] for c in s_cols)
        ok_n = len(s_rows) == len(d_rows)
        ok_vals = ok_cols and rows_of(s_cols, s_rows) == rows_of(d_cols, d_rows)
        status = "OK" if (ok_cols and ok_types and ok_n and ok_vals) else "MISMATCH"
        detail = ""
        if status != "OK":
            detail = f"cols={ok_cols} types={ok_types} n={len(s_rows)}/{len(d_rows)} vals={ok_vals}"
            if not ok_cols:
                detail += f" spark={sorted(s_cols)} duck={sorted(d_cols)}"
            elif not ok_types:
                diff = {c: (s_types[c], d_types[c]) for c in s_cols if s_types[c] != d_types[c]}
                detail += " " + str(diff)
            elif not ok_vals:
                a = rows_of(s_cols, s_rows)
                b = rows_of(d_cols, d_rows)
                sa, sb = set(a), set(b)
                detail += f" spark-only={list(sa - sb)[:3]} duck-only={list(sb - sa)[:3]}"
        results[name] = (status, detail)
        if verbose:
            print(f"{name:32s} {status} n={len(s_rows)} ({t_spark:.1f}s) {detail}")
    return results


def main():
    from tidemark.session import build_session
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    spark = build_session("local[8]", 8)
    res = check(spark, sf_dir, names)
    bad = [k for k, v in res.items() if v[0] not in ("OK", "rows-only")]
    print(f"{len(res) - len(bad)}/{len(res)} ok; bad={bad}")


if __name__ == "__main__":
    main()
