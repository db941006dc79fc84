"""Run registered queries beside their DuckDB texts.

``python -m tests.oracle [--sf 0.01] [key ...]`` prints one line per query.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

import duckdb

TESTDATA = os.environ.get("THALWEG_TESTDATA", "/root/testdata")
NAMES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in NAMES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, int):
        return repr(value)
    if isinstance(value, (dt.datetime, dt.date)):
        return value.isoformat()
    return str(value)


def _kind(value):
    if value is None:
        return None
    return type(value).__name__


def compare(spark, con, fn, sql: str | None, sf_dir: str):
    """(row count, None) where equal, else (row count, what differs)."""
    df = fn(spark, sf_dir)
    rows = df.collect()
    if sql is None:
        return len(rows), None
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = cur.fetchall()
    if sorted(df.columns) != sorted(names):
        return len(rows), f"columns {sorted(df.columns)} != {sorted(names)}"
    order = sorted(names)
    pick = [names.index(c) for c in order]
    a = sorted(tuple(_cell(r[c]) for c in order) for r in rows)
    b = sorted(tuple(_cell(r[i]) for i in pick) for r in want)
    if len(a) != len(b):
        return len(rows), f"rows {len(a)} != {len(b)}; only spark {list(set(a) - set(b))[:2]}; only duck {list(set(b) - set(a))[:2]}"
    if a != b:
        left, right = sorted(set(a) - set(b)), sorted(set(b) - set(a))
        return len(rows), f"{len(left)} values differ over {order}: spark {left[:2]} duck {right[:2]}"
    for i, c in enumerate(order):
        kinds = {_kind(r[c]) for r in rows} - {None}
        others = {_kind(r[pick[i]]) for r in want} - {None}
        if kinds != others:
            return len(rows), f"type of {c}: spark {kinds} duck {others}"
    return len(rows), None


def main(argv):
    sf = "0.01"
    if "--sf" in argv:
        at = argv.index("--sf")
        sf = argv[at + 1]
        argv = argv[:at] + argv[at + 2 :]
    from thalweg.catalog import ORACLES, QUERIES
    from thalweg.session import local_session

    spark = local_session()
    sf_dir = f"{TESTDATA}/sf{sf}"
    con = connect(sf_dir)
    keys = [k for k in QUERIES if not argv or any(k == a or (a.endswith("*") and k.startswith(a[:-1])) for a in argv)]
    bad = 0
    for key in keys:
        start = time.time()
        try:
            n, problem = compare(spark, con, QUERIES[key], ORACLES.get(key), sf_dir)
        except Exception as e:  # noqa: BLE001
            n, problem = -1, f"{type(e).__name__}: {str(e)[:700]}"
        bad += problem is not None
        mark = "FAIL" if problem else ("ok  " if key in ORACLES else "rows")
        print(f"{mark} {key:32s} {n:7d} rows {time.time() - start:6.2f}s {problem or ''}", flush=True)
    print(f"{len(keys)} queries, {bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
