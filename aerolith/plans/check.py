"""Local twin of the driver's correctness gate.

``python -m aerolith.plans.check [--sf DIR] [names...]`` runs each registered query
on Spark and its SQL twin on DuckDB over the same parquet files and compares row
count, column names and the order-insensitive multiset of rows.
"""

from __future__ import annotations

import argparse
import math
import sys
import time

import duckdb

from aerolith.sources.fixtures import TABLES


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6) + 0.0
    if hasattr(v, "tolist"):
        return tuple(v.tolist())
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _key(row):
    return tuple((0, "") if x is None else (1, str(x)) for x in row)


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(_norm(r[c]) for c in sorted(s_cols)) for r in sdf.collect()]
    t1 = time.time()
    if sql is None:
        return dict(name=name, rows=len(s_rows), oracle=None, spark_s=round(t1 - t0, 2))
    cur = con.execute(sql)
    d_cols = [d[0] for d in cur.description]
    d_raw = cur.fetchall()
    idx = {c: i for i, c in enumerate(d_cols)}
    res = dict(name=name, rows=len(s_rows), oracle_rows=len(d_raw), spark_s=round(t1 - t0, 2))
    if sorted(s_cols) != sorted(d_cols):
        res["cols"] = f"spark-only {sorted(set(s_cols) - set(d_cols))} sql-only {sorted(set(d_cols) - set(s_cols))}"
        res["ok"] = False
        return res
    d_rows = [tuple(_norm(r[idx[c]]) for c in sorted(s_cols)) for r in d_raw]
    a, b = sorted(s_rows, key=_key), sorted(d_rows, key=_key)
    res["ok"] = a == b
    if not res["ok"]:
        diffs = [(x, y) for x, y in zip(a, b) if x != y][:2]
        res["first_diff"] = diffs
        res["cols_sorted"] = sorted(s_cols)
    return res


def main(argv=None):
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args(argv)
    from aerolith.config import clear_scratch, get_session
    from aerolith.plans import oracle_sql, queries

    spark = get_session("local[8]", shuffle_partitions=8)
    con = duck(args.sf)
    qs, sq = queries(), oracle_sql()
    names = args.names or list(qs)
    bad = 0
    for n in names:
        try:
            r = compare(spark, con, n, qs[n], sq.get(n), args.sf)
        except Exception as e:  # report and continue
            r = dict(name=n, ok=False, error=f"{type(e).__name__}: {str(e)[:600]}")
        bad += r.get("ok") is False
        print(r, flush=True)
        clear_scratch(spark)
    print(f"{len(names) - bad}/{len(names)} ok")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
