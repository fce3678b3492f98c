"""Run a registered Spark query and its DuckDB oracle side by side.

Mirrors the driver's check: row count, column names (sorted) and an
order-insensitive comparison of all values.
"""

from __future__ import annotations

import math
import os
import sys

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from churnlens.sources.fixtures import TABLES  # noqa: E402


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (1, "nan")
        return (1, repr(float(v)))
    if isinstance(v, bool):
        return (1, repr(int(v)))
    if isinstance(v, int):
        return (1, repr(float(v)) if abs(v) < 2**53 else repr(v))
    if hasattr(v, "tolist"):
        return (2, repr(v.tolist()))
    if isinstance(v, (list, tuple)):
        return (2, repr([_norm(x) for x in v]))
    return (3, str(v))


def compare(spark, name: str, fn, sql: str, sf_dir: str, con=None) -> dict:
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    con = con or duck(sf_dir)
    rel = con.sql(sql)
    d_cols = list(rel.columns)
    d_rows = rel.fetchall()
    out = {"name": name, "spark_rows": len(s_rows), "oracle_rows": len(d_rows),
           "cols_match": sorted(s_cols) == sorted(d_cols)}
    if out["cols_match"]:
        s_order = sorted(range(len(s_cols)), key=lambda i: s_cols[i])
        d_order = sorted(range(len(d_cols)), key=lambda i: d_cols[i])
        s_vals = sorted(tuple(_norm(r[i]) for i in s_order) for r in s_rows)
        d_vals = sorted(tuple(_norm(r[i]) for i in d_order) for r in d_rows)
        out["values_match"] = s_vals == d_vals
        if not out["values_match"]:
            diff_s = [r for r in s_vals if r not in set(d_vals)][:3]
            diff_d = [r for r in d_vals if r not in set(s_vals)][:3]
            out["only_spark"] = diff_s
            out["only_oracle"] = diff_d
    else:
        out["spark_cols"] = s_cols
        out["oracle_cols"] = d_cols
        out["values_match"] = False
    out["ok"] = out["cols_match"] and out["values_match"] and len(s_rows) == len(d_rows)
    return out


def main(argv: list[str]) -> int:
    import time

    from churnlens.session import local_session
    import __spark_entry__ as entry

    sf_dir = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    names = argv or sorted(entry.oracle_sql())
    spark = local_session(8)
    con = duck(sf_dir)
    qs, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for n in names:
        t0 = time.time()
        if n not in sqls:
            df = qs[n](spark, sf_dir)
            print(f"{n}: rows-only {df.count()} rows ({time.time()-t0:.1f}s)", flush=True)
            continue
        try:
            r = compare(spark, n, qs[n], sqls[n], sf_dir, con)
        except Exception as exc:  # report and continue
            r = {"name": n, "ok": False, "error": repr(exc)[:2000]}
        r["sec"] = round(time.time() - t0, 1)
        bad += 0 if r["ok"] else 1
        print(r if not r["ok"] else f"{n}: OK {r['spark_rows']} rows ({r['sec']}s)", flush=True)
    print(f"{len(names) - bad}/{len(names)} ok")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
