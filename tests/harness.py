"""Spark-vs-DuckDB comparison in the manner of the driver's correctness gate."""

from __future__ import annotations

import hashlib
import math
import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parents[1]
if str(ROOT) not in sys.path:
    sys.path.insert(0, str(ROOT))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    out.sort(key=lambda r: repr(r))
    return [cols[i] for i in order], out


def compare_one(spark, con, name, qfn, sql, sf_dir):
    t0 = time.time()
    sdf = qfn(spark, sf_dir)
    scols = sdf.columns
    srows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    res = {"name": name, "spark_rows": len(srows), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        res["status"] = "rows-only"
        return res
    cur = con.execute(sql)
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    res["duck_rows"] = len(drows)
    sc, sr = _rows(scols, srows)
    dc, dr = _rows(dcols, drows)
    if sc != dc:
        res["status"] = f"schema mismatch spark={sc} duck={dc}"
        return res
    if len(sr) != len(dr):
        res["status"] = "rowcount mismatch"
        return res
    hs = hashlib.md5(repr(sr).encode()).hexdigest()
    hd = hashlib.md5(repr(dr).encode()).hexdigest()
    if hs != hd:
        diff = [(a, b) for a, b in zip(sr, dr) if a != b][:3]
        res["status"] = "value mismatch"
        res["diff"] = diff
        return res
    res["status"] = "ok"
    return res


def main(argv):
    from tallyspark.session import get_spark
    import __spark_entry__ as E

    import os
    sf_dir = os.environ.get("HARNESS_SF_DIR", "/root/testdata/sf0.01")
    names = argv[1:] or None
    spark = get_spark(master="local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    qs, oracle = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        try:
            r = compare_one(spark, con, name, fn, oracle.get(name), sf_dir)
        except Exception as exc:  # report and continue
            r = {"name": name, "status": f"error {type(exc).__name__}: {str(exc)[:400]}"}
        if r["status"] not in ("ok", "rows-only"):
            bad += 1
        print(r, flush=True)
    print("BAD", bad)


if __name__ == "__main__":
    main(sys.argv)
