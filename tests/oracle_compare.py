"""Spark-vs-DuckDB comparison in the driver's style (rows, names, exact values)."""

from __future__ import annotations

import datetime as dt
import math
import sys
import time

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def canon(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        return repr(float(v))
    if hasattr(v, "isoformat"):
        if isinstance(v, dt.datetime) or hasattr(v, "to_pydatetime"):
            return v.isoformat(sep=" ")
        return v.isoformat()
    if hasattr(v, "item"):
        return canon(v.item())
    return str(v)


def rows_of(pdf) -> list[tuple]:
    cols = sorted(pdf.columns)
    out = []
    for rec in pdf[cols].itertuples(index=False, name=None):
        out.append(tuple(canon(x) for x in rec))
    return sorted(out)


def compare(spark, sf_dir: str, names=None, verbose=True) -> dict:
    sys.path.insert(0, "/root/repo")
    import __spark_entry__ as E
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    result = {}
    for name in names or list(qs):
        t = time.time()
        rec = {"oracle": name in sqls}
        try:
            sdf = qs[name](spark, sf_dir)
            sp = sdf.toPandas()
            rec["rows"] = len(sp)
            if name in sqls:
                dk = con.sql(sqls[name]).df()
                rec["oracle_rows"] = len(dk)
                rec["names_match"] = sorted(sp.columns) == sorted(dk.columns)
                a, b = rows_of(sp), rows_of(dk)
                rec["values_match"] = rec["names_match"] and a == b
                if not rec["values_match"] and rec["names_match"]:
                    diff = [(x, y) for x, y in zip(a, b) if x != y][:2]
                    rec["diff"] = diff
                elif not rec["names_match"]:
                    rec["diff"] = (sorted(sp.columns), sorted(dk.columns))
        except Exception as e:  # noqa: BLE001
            rec["error"] = repr(e)[:600]
        rec["sec"] = round(time.time() - t, 2)
        result[name] = rec
        if verbose:
            ok = rec.get("values_match", rec.get("rows", -1) >= 0 and "error" not in rec)
            print(("OK  " if ok else "FAIL"), name, {k: v for k, v in rec.items() if k != "oracle"}, flush=True)
    return result


