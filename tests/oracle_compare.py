"""Run a Spark query and its DuckDB oracle on the same parquet tables and compare.

Mirrors the driver's check: column names (sorted), row count, and an
order-insensitive comparison of the values (floats rounded to 6 places).
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, bool):
        return (1, str(v))
    if isinstance(v, float):
        if math.isnan(v):
            return (2, "nan")
        return (2, f"{round(v, 6):.6f}")
    if isinstance(v, int):
        return (3, str(v))
    return (4, str(v))


def rows_of_spark(df):
    cols = sorted(df.columns)
    return cols, sorted(tuple(_norm(r[c]) for c in cols) for r in df.collect())


def rows_of_duck(con, sql):
    rel = con.sql(sql)
    names = rel.columns
    data = rel.fetchall()
    cols = sorted(names)
    idx = [names.index(c) for c in cols]
    return cols, sorted(tuple(_norm(r[i]) for i in idx) for r in data), rel.types


def compare(spark, sf_dir, name, fn, sql, con=None):
    con = con or duck(sf_dir)
    df = fn(spark, sf_dir)
    s_cols, s_rows = rows_of_spark(df)
    d_cols, d_rows, _ = rows_of_duck(con, sql)
    problems = []
    if s_cols != d_cols:
        problems.append(f"columns differ: spark={s_cols} duck={d_cols}")
    if len(s_rows) != len(d_rows):
        problems.append(f"row count spark={len(s_rows)} duck={len(d_rows)}")
    elif s_rows != d_rows:
        diff = [(a, b) for a, b in zip(s_rows, d_rows) if a != b][:3]
        problems.append(f"values differ, e.g. {diff}")
    return problems, len(s_rows)


if __name__ == "__main__":
    sys.path.insert(0, ".")
    from __spark_entry__ import oracle_sql, queries
    from playtrack.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 and sys.argv[1].startswith("/") else "/root/testdata/sf0.01"
    only = [a for a in sys.argv[1:] if not a.startswith("/")]
    spark = build_session("local[8]")
    con = duck(sf)
    q, o = queries(), oracle_sql()
    bad = 0
    for name in sorted(q):
        if only and name not in only:
            continue
        t0 = time.time()
        if name not in o:
            try:
                rows = q[name](spark, sf).count()
                print(f"{name:40s} rows-only {rows} ({time.time() - t0:.1f}s)", flush=True)
            except Exception as exc:  # noqa: BLE001
                bad += 1
                print(f"{name:40s} FAIL error: {type(exc).__name__}: {str(exc)[:300]}", flush=True)
            continue
        try:
            problems, n = compare(spark, sf, name, q[name], o[name], con)
        except Exception as exc:  # noqa: BLE001
            problems, n = [f"error: {type(exc).__name__}: {str(exc)[:300]}"], -1
        status = "OK" if not problems else "FAIL " + "; ".join(problems)
        bad += bool(problems)
        print(f"{name:40s} {n:7d} {status} ({time.time() - t0:.1f}s)", flush=True)
    print(f"{bad} failing of {len(q)}")
