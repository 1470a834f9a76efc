"""Compare registered Spark queries with their DuckDB oracle SQL.

Usage: ``python tests/oracle_compare.py [sf_dir] [name ...]``.  Prints one line
per query and exits non-zero on any mismatch.
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return ("nan",)
        return v            # exact: results must match bit for bit, like a value hash
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    if hasattr(v, "item"):
        return v.item()
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0)
                                           for x in r))


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    df = fn(spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    t1 = time.time()
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    problems = []
    if sorted(s_cols) != sorted(d_cols):
        problems.append(f"columns spark={s_cols} duck={d_cols}")
    if len(s_rows) != len(d_rows):
        problems.append(f"rows spark={len(s_rows)} duck={len(d_rows)}")
    if not problems:
        a, b = _rows(s_cols, s_rows), _rows(d_cols, d_rows)
        if a != b:
            diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
            problems.append(f"values differ, e.g. {diff}")
    return problems, t1 - t0, len(s_rows)


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    only = set(argv[2:])
    from metricfold.session import build_session
    import __spark_entry__ as entry

    spark = build_session("local[8]", shuffle_partitions=8)
    con = duck(sf_dir)
    queries, oracle = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, fn in queries.items():
        if only and name not in only:
            continue
        if name not in oracle:
            print(f"{name:32s} no oracle")
            continue
        try:
            problems, secs, n = compare(spark, con, name, fn, oracle[name], sf_dir)
        except Exception as exc:  # report and continue
            problems, secs, n = [f"error: {type(exc).__name__}: {str(exc)[:400]}"], 0.0, -1
        status = "ok" if not problems else "MISMATCH " + "; ".join(problems)
        bad += bool(problems)
        print(f"{name:32s} {secs:6.2f}s rows={n:<7d} {status}", flush=True)
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
