"""Run registered queries and their DuckDB oracles side by side and compare.

Usage: python tests/oracle_check.py [sf_dir] [key ...]
Compares row count, column names and an order-insensitive hash of the values
(columns sorted by name), and prints the first differing rows on mismatch.
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return repr(float(v))   # strict: -0.0 and 0.0 hash differently
    if isinstance(v, dt.datetime):
        return v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if hasattr(v, "item"):
        return norm(v.item())
    return str(v)


def canon(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(norm(r[i]) for i in order) for r in rows), [columns[i] for i in order]


def compare(spark, sf_dir: str, keys=None, verbose=True):
    import __spark_entry__ as E
    from finmart.session import stage_scope
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for k in keys or list(qs):
        t0 = time.time()
        try:
            with stage_scope(spark):
                df = qs[k](spark, sf_dir)
                srows = [tuple(r) for r in df.collect()]
                scols = df.columns
                stypes = [f.dataType.simpleString() for f in df.schema.fields]
        except Exception as exc:  # noqa: BLE001
            results[k] = ("SPARK_ERROR", str(exc)[:400])
            print(k, "SPARK_ERROR", str(exc)[:800])
            continue
        ts = time.time() - t0
        if k not in sqls:
            results[k] = ("NO_ORACLE", len(srows))
            print(f"{k}: NO_ORACLE rows={len(srows)} {ts:.1f}s")
            continue
        try:
            rel = con.execute(sqls[k])
            dcols = [d[0] for d in rel.description]
            drows = rel.fetchall()
            dtypes = [str(d[1]) for d in rel.description]
        except Exception as exc:  # noqa: BLE001
            results[k] = ("SQL_ERROR", str(exc)[:400])
            print(k, "SQL_ERROR", str(exc)[:800])
            continue
        a, ac = canon(scols, srows)
        b, bc = canon(dcols, drows)
        ok = ac == bc and a == b
        status = "OK" if ok else "MISMATCH"
        results[k] = (status, len(srows), len(drows))
        print(f"{k}: {status} spark={len(srows)} duck={len(drows)} {ts:.1f}s")
        if not ok and verbose:
            if ac != bc:
                print("   cols spark:", ac)
                print("   cols duck :", bc)
            else:
                sa, sb = set(a), set(b)
                print("   spark-only:", sorted(sa - sb)[:3])
                print("   duck-only :", sorted(sb - sa)[:3])
        if verbose and ok:
            tmap = dict(zip(scols, stypes))
            dmap = dict(zip(dcols, dtypes))
            mism = {c: (tmap[c], dmap.get(c)) for c in scols
                    if not _type_ok(tmap[c], dmap.get(c))}
            if mism:
                print("   type diffs:", mism)
    return results


def _type_ok(s, d):
    pairs = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
             "date": "DATE", "boolean": "BOOLEAN"}
    return pairs.get(s) == d


if __name__ == "__main__":
    from finmart.session import get_spark
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    keys = sys.argv[2:] or None
    spark = get_spark("local[8]", shuffle_partitions=8)
    res = compare(spark, sf, keys)
    bad = [k for k, v in res.items() if v[0] not in ("OK", "NO_ORACLE")]
    print("FAILED:", bad)
