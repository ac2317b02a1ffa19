"""Run registered Spark queries and their DuckDB oracle side by side.

Usage: python -m tests.compare [sf_dir] [name ...]
Compares column names, row counts and the multiset of canonicalised rows.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time
from collections import Counter

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def canon(v):
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, decimal.Decimal):
        return repr(float(v))
    if isinstance(v, dt.datetime):
        if v.tzinfo is not None:
            v = v.astimezone(dt.timezone.utc).replace(tzinfo=None)
        return v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(canon(x) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{canon(x)}" for k, x in sorted(v.items())) + "}"
    return str(v)


SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
                 "timestamp": "TIMESTAMP", "date": "DATE", "boolean": "BOOLEAN"}


def type_mismatches(sdf, rel) -> list:
    """Columns whose Spark type and DuckDB type differ."""
    s = {f.name: f.dataType.simpleString() for f in sdf.schema.fields}
    d = dict(zip(rel.columns, [str(t) for t in rel.types]))
    return [(c, s[c], d.get(c)) for c in s if SPARK_TO_DUCK.get(s[c], s[c]) != d.get(c)]


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, sf_dir: str, names=None, verbose=True):
    from streetlake.plans.catalog import oracle_sql, queries
    qs, os_ = queries(), oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name in names or list(qs):
        t0 = time.time()
        try:
            sdf = qs[name](spark, sf_dir)
            scols = sdf.columns
            srows = [tuple(r) for r in sdf.collect()]
        except Exception as e:  # noqa: BLE001
            results[name] = f"SPARK ERROR {type(e).__name__}: {str(e)[:300]}"
            print(name, results[name]) if verbose else None
            continue
        t1 = time.time()
        if name not in os_:
            results[name] = f"rows-only {len(srows)}"
            print(f"{name:28s} {results[name]} spark={t1-t0:.2f}s") if verbose else None
            continue
        try:
            rel = con.sql(os_[name])
            dcols = rel.columns
            drows = rel.fetchall()
        except Exception as e:  # noqa: BLE001
            results[name] = f"DUCKDB ERROR {str(e)[:300]}"
            print(name, results[name]) if verbose else None
            continue
        ok_cols = sorted(scols) == sorted(dcols)
        types_bad = type_mismatches(sdf, rel) if ok_cols else []
        if types_bad:
            results[name] = f"TYPES differ {types_bad}"
            print(name, results[name]) if verbose else None
            continue
        if not ok_cols:
            results[name] = f"COLUMNS differ spark={sorted(scols)} duck={sorted(dcols)}"
            print(name, results[name]) if verbose else None
            continue
        order = sorted(scols)
        si = [scols.index(c) for c in order]
        di = [dcols.index(c) for c in order]
        sc = Counter(tuple(canon(r[i]) for i in si) for r in srows)
        dc = Counter(tuple(canon(r[i]) for i in di) for r in drows)
        if sc == dc:
            results[name] = f"OK rows={len(srows)}"
        else:
            only_s = list((sc - dc).elements())[:3]
            only_d = list((dc - sc).elements())[:3]
            results[name] = (f"MISMATCH spark={len(srows)} duck={len(drows)} cols={order}\n"
                             f"   spark-only {only_s}\n   duck-only  {only_d}")
        if verbose:
            print(f"{name:28s} {results[name]} spark={t1-t0:.2f}s")
    return results


if __name__ == "__main__":
    sys.path.insert(0, ".")
    from streetlake.session import build_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    res = compare(spark, sf, sys.argv[2:] or None)
    bad = [k for k, v in res.items() if not (v.startswith("OK") or v.startswith("rows-only"))]
    print("FAILED:", bad)
