"""Run registered queries in Spark and their DuckDB twins; compare rows.

    python tests/oracle_check.py [sf_dir] [name ...]

Comparison: row count, column names, and the multiset of rows (columns
sorted by name, values normalised to strings).
"""

from __future__ import annotations

import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return repr(round(v, 9))
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    return str(v)


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, sf_dir: str, names=None) -> dict:
    import __spark_entry__ as e
    qs, sql = e.queries(), e.oracle_sql()
    con = duck(sf_dir)
    out = {}
    for name in names or list(qs):
        t0 = time.time()
        try:
            df = qs[name](spark, sf_dir)
            s_cols = df.columns
            s_rows = [tuple(r) for r in df.collect()]
        except Exception as ex:  # noqa: BLE001
            out[name] = ("SPARK-ERROR", str(ex)[:400])
            continue
        t1 = time.time()
        if name not in sql:
            out[name] = ("rows-only", len(s_rows), round(t1 - t0, 2))
            continue
        try:
            rel = con.sql(sql[name])
            d_cols = rel.columns
            d_rows = rel.fetchall()
        except Exception as ex:  # noqa: BLE001
            out[name] = ("SQL-ERROR", str(ex)[:400])
            continue
        if sorted(s_cols) != sorted(d_cols):
            out[name] = ("COLS", s_cols, d_cols)
            continue
        a, b = rows_of(s_cols, s_rows), rows_of(d_cols, d_rows)
        if a == b:
            out[name] = ("OK", len(a), round(t1 - t0, 2))
        else:
            sa, sb = set(a), set(b)
            out[name] = ("DIFF", len(a), len(b), list(sa - sb)[:2], list(sb - sa)[:2])
    return out


if __name__ == "__main__":
    from tokenloom.session import build_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    spark = build_session("local[8]")
    res = compare(spark, sf, names)
    for k, v in res.items():
        print(k, *v if isinstance(v, tuple) else v, flush=True)
    bad = [k for k, v in res.items() if v[0] not in ("OK", "rows-only")]
    print("FAILED:", bad)
