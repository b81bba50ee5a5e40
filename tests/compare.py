"""Runs named queries beside their SQL text and compares the results as multisets of rows.

    python tests/compare.py [--sf 0.01] [name prefix ...]
"""

from __future__ import annotations

import datetime as dt
import math
import sys
import time
from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def engine(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (Decimal, int)):
        return int(value) if value == int(value) else float(value)
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return int(value) if value.is_integer() else round(value, 6)
    if isinstance(value, dt.datetime):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def as_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(repr(plain(r[i])) for i in order) for r in rows)


def compare(query, spark, con, sf_dir):
    """(difference or None, number of rows)"""
    df = query(spark, sf_dir)
    got = as_rows(df.columns, [tuple(r) for r in df.collect()])
    total = sum(got.values())
    if query.sql is None:
        return None, total
    cur = con.execute(query.sql)
    names = [d[0] for d in cur.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} but SQL has {sorted(names)}", total
    want = as_rows(names, cur.fetchall())
    if got == want:
        return None, total
    only_spark, only_sql = got - want, want - got
    return (
        f"{total} rows, SQL {sum(want.values())}; {sum(only_spark.values())} only in Spark, e.g. "
        f"{[next(iter(only_spark.elements()), None)]}; {sum(only_sql.values())} only in SQL, e.g. "
        f"{[next(iter(only_sql.elements()), None)]} (columns {sorted(names)})"
    ), total


def main(argv):
    from session import local_session

    from billtrace.registry import REGISTRY

    sf = "0.01"
    if "--sf" in argv:
        i = argv.index("--sf")
        sf = argv[i + 1]
        argv = argv[:i] + argv[i + 2 :]
    sf_dir = f"/root/testdata/sf{sf}"
    spark, con = local_session(), engine(sf_dir)
    bad = 0
    for name, q in REGISTRY.items():
        if argv and not any(name.startswith(p) for p in argv):
            continue
        start = time.time()
        try:
            diff, n = compare(q, spark, con, sf_dir)
        except Exception as exc:  # report and go on with the next query
            diff, n = f"{type(exc).__name__}: {str(exc)[:1500]}", -1
        mark = "ok  " if diff is None else "FAIL"
        bad += diff is not None
        print(f"{mark} {name} rows={n} {time.time() - start:.1f}s{'' if q.sql else ' (no SQL)'}", flush=True)
        if diff:
            print("     ", diff[:1100], flush=True)
    print(f"{bad} failed")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
