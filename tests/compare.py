"""Runs named queries next to their DuckDB counterparts. Usage: compare.py sf_dir [names]."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("set TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _cell(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "NULL" if math.isnan(v) else f"{v:.9g}"
    if hasattr(v, "as_tuple"):
        return f"{float(v):.9g}"
    return str(v)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i].lower())
    return [names[i].lower() for i in order], sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def difference(df, con, sql) -> str | None:
    """None when both sides hold the same rows; otherwise a short description."""
    cols, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    want_cols, want = rows_of([d[0] for d in cur.description], cur.fetchall())
    if cols != want_cols:
        return f"columns differ: only spark {set(cols) - set(want_cols)}, only duckdb {set(want_cols) - set(cols)}"
    if got == want:
        return None
    g, w = set(got) - set(want), set(want) - set(got)
    text = f"rows {len(got)} vs {len(want)}, {len(g)} only spark, {len(w)} only duckdb"
    if g and w:
        a, b = min(g), min(w)
        text += f"; first pair: { {c: (x, y) for c, x, y in zip(cols, a, b) if x != y} }"
    return text


if __name__ == "__main__":
    import __spark_entry__ as entry
    from tallyward.session import local_session

    sf = sys.argv[1]
    spark, con = local_session("8"), connect(sf)
    qs, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in sys.argv[2:] or list(qs):
        t = time.time()
        try:
            df = qs[name](spark, sf)
            if name in oracles:
                n, problem = None, difference(df, con, oracles[name])
            else:
                n, problem = df.count(), None
        except Exception as e:
            n, problem = None, f"{type(e).__name__}: {str(e)[:700]}"
        bad += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name:34s} {time.time() - t:6.1f}s {'' if n is None else n} {problem or ''}", flush=True)
    print("failures:", bad)
