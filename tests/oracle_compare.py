"""Run a registered query on Spark and its oracle SQL on DuckDB; compare.

Usage: python tests/oracle_compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if isinstance(v, dt.datetime):
        return v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return _norm(v.asDict())
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def compare(spark, sf_dir: str, name: str, con=None) -> dict:
    import __spark_entry__ as E

    con = con or duck(sf_dir)
    t0 = time.time()
    sdf = E.queries()[name](spark, sf_dir)
    s_cols = sdf.columns
    s_rows = sdf.collect()
    t1 = time.time()
    out = {"name": name, "spark_rows": len(s_rows), "spark_sec": round(t1 - t0, 2)}
    sql = E.oracle_sql().get(name)
    if sql is None:
        out["oracle"] = "none"
        return out
    rel = con.sql(sql)
    d_cols = rel.columns
    d_rows = rel.fetchall()
    out["duck_rows"] = len(d_rows)
    out["cols_equal"] = sorted(s_cols) == sorted(d_cols)
    if not out["cols_equal"]:
        out["spark_cols"] = s_cols
        out["duck_cols"] = d_cols
        return out
    order = sorted(s_cols)
    si = [s_cols.index(c) for c in order]
    di = [d_cols.index(c) for c in order]
    sset = sorted((tuple(_norm(r[i]) for i in si) for r in s_rows), key=repr)
    dset = sorted((tuple(_norm(r[i]) for i in di) for r in d_rows), key=repr)
    out["values_equal"] = sset == dset
    if not out["values_equal"]:
        from collections import Counter

        cs, cd = Counter(sset), Counter(dset)
        only_s = list((cs - cd).elements())[:3]
        only_d = list((cd - cs).elements())[:3]
        out["cols"] = order
        out["only_spark"] = only_s
        out["only_duck"] = only_d
    return out


def main(argv):
    from regfuse.session import local_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    import __spark_entry__ as E

    names = argv[2:] or list(E.queries())
    spark = local_session()
    con = duck(sf_dir)
    bad = 0
    for n in names:
        try:
            r = compare(spark, sf_dir, n, con)
        except Exception as e:  # report and go on
            r = {"name": n, "error": repr(e)[:800]}
        ok = r.get("values_equal", r.get("oracle") == "none") and "error" not in r
        bad += not ok
        print(("OK   " if ok else "FAIL ") + repr(r), flush=True)
    print(f"{len(names) - bad}/{len(names)} ok")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
