"""Run a registered Spark query and its DuckDB oracle on the same tables and compare them.

Comparison: row count, column names (sorted), and the multiset of rows with columns taken in name order.
"""

from __future__ import annotations

import math
from collections import Counter
from decimal import Decimal

import duckdb

from tessera.sources.tables import TABLES


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, Decimal):
        v = float(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        if v == int(v) and abs(v) < 2 ** 53:
            return int(v)
        return v
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "asDict"):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def compare(spark, name: str, spark_df, sql: str, sf_dir: str, show: int = 3) -> dict:
    con = duck(sf_dir)
    res = con.execute(sql)
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    scols = spark_df.columns
    srows = [tuple(r) for r in spark_df.collect()]
    out = {"name": name, "spark_rows": len(srows), "oracle_rows": len(orows),
           "cols_match": sorted(scols) == sorted(ocols)}
    if out["cols_match"]:
        order_s = [scols.index(c) for c in sorted(scols)]
        order_o = [ocols.index(c) for c in sorted(ocols)]
        cs = Counter(tuple(_norm(r[i]) for i in order_s) for r in srows)
        co = Counter(tuple(_norm(r[i]) for i in order_o) for r in orows)
        out["values_match"] = cs == co
        if not out["values_match"]:
            out["only_spark"] = list((cs - co).elements())[:show]
            out["only_oracle"] = list((co - cs).elements())[:show]
            out["columns"] = sorted(scols)
    else:
        out["values_match"] = False
        out["spark_cols"], out["oracle_cols"] = scols, ocols
    out["ok"] = out["values_match"] and out["spark_rows"] == out["oracle_rows"]
    return out
