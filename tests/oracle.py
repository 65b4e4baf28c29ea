"""Compare a Spark result with a DuckDB oracle query on the same parquet tables."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (dt.date,)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def compare(sdf, sql: str, con) -> dict:
    """Row count, column names and an order-insensitive multiset of normalised rows."""
    rel = con.sql(sql)
    dcols = list(rel.columns)
    drows = rel.fetchall()
    scols = sdf.columns
    srows = [tuple(r) for r in sdf.collect()]
    out = {"spark_rows": len(srows), "oracle_rows": len(drows),
           "cols_match": sorted(scols) == sorted(dcols)}
    if not out["cols_match"]:
        out["cols"] = (sorted(set(scols) - set(dcols)), sorted(set(dcols) - set(scols)))
        out["ok"] = False
        return out
    order = sorted(scols)
    si = [scols.index(c) for c in order]
    di = [dcols.index(c) for c in order]
    sc = Counter(tuple(_norm(r[i]) for i in si) for r in srows)
    dc = Counter(tuple(_norm(r[i]) for i in di) for r in drows)
    out["ok"] = sc == dc
    if not out["ok"]:
        out["spark_only"] = list((sc - dc).items())[:3]
        out["oracle_only"] = list((dc - sc).items())[:3]
        out["cols"] = order
    return out
