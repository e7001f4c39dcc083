"""Spark result vs DuckDB oracle: sorted column names, row count, coarse types, row multiset."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
from collections import Counter

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return str(v.normalize()) if v != v.to_integral_value() else format(v.normalize(), "f")
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return v


def kind(t: str) -> str:
    t = t.lower().replace(" ", "")
    if t.startswith("decimal"):
        return t
    if t in ("bigint", "long", "hugeint"):
        return "int64"
    if t in ("int", "integer"):
        return "int32"
    if t in ("double", "float"):
        return "float"
    if t in ("string", "varchar"):
        return "str"
    if t.startswith("timestamp"):
        return "ts"
    return t


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(df, con, sql: str) -> list[str]:
    srows = [tuple(norm(x) for x in r) for r in df.collect()]
    scols = df.columns
    stypes = [kind(f.dataType.simpleString()) for f in df.schema.fields]
    cur = con.execute(sql)
    drows = [tuple(norm(x) for x in r) for r in cur.fetchall()]
    dcols = [d[0] for d in cur.description]
    dtypes = [kind(str(d[1])) for d in cur.description]
    problems = []
    if sorted(scols) != sorted(dcols):
        return [f"cols spark={scols} duck={dcols}"]
    so = sorted(range(len(scols)), key=lambda i: scols[i])
    do = sorted(range(len(dcols)), key=lambda i: dcols[i])
    if [stypes[i] for i in so] != [dtypes[i] for i in do]:
        problems.append(f"types spark={[stypes[i] for i in so]} duck={[dtypes[i] for i in do]}")
    if len(srows) != len(drows):
        problems.append(f"rows spark={len(srows)} duck={len(drows)}")
    sc = Counter(tuple(r[i] for i in so) for r in srows)
    dc = Counter(tuple(r[i] for i in do) for r in drows)
    if sc != dc:
        problems.append(f"values differ; spark-only {list((sc - dc).elements())[:3]} "
                        f"duck-only {list((dc - sc).elements())[:3]}")
    return problems
