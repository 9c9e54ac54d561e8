"""Run registered queries and their SQL on the same folder and compare.

    python tests/oracle_check.py [folder] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def _key(row):
    return tuple((v is None, str(type(v)), v) if not isinstance(v, float) else (v is None, "f", v) for v in row)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(row[i] for i in order) for row in rows]
    return sorted(columns), sorted(out, key=lambda r: str(r))


def compare(df, con, sql: str) -> str | None:
    """None when equal, otherwise what differs."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    want_cols, want = rows_of(names, result.fetchall())
    got_cols, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    for a, b in zip(got, want):
        for c, x, y in zip(got_cols, a, b):
            if type(x) is not type(y):
                return f"{c}: {x!r} ({type(x).__name__}) != {y!r} ({type(y).__name__}) in {a} vs {b}"
            if x != y and not (isinstance(x, float) and math.isnan(x) and math.isnan(y)):
                return f"{c}: {x!r} != {y!r} in {a} vs {b}"
    return None


def main() -> int:
    from reconkit import queries
    from reconkit.session import local_session

    queries.load()
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:] or list(queries.QUERIES)
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(folder), 0
    for name in chosen:
        start = time.time()
        try:
            df = queries.QUERIES[name](spark, folder)
            sql = queries.ORACLE.get(name)
            n = None if sql else df.count()
            problem = compare(df, con, sql) if sql else (None if n else "no rows")
        except Exception as e:  # noqa: BLE001
            problem = f"{type(e).__name__}: {str(e)[:700]}"
        kind = "ok  " if name in queries.ORACLE else "rows"
        print(f"{'BAD ' if problem else kind} {name} {time.time() - start:.2f}s {problem or ''}", flush=True)
        bad += bool(problem)
    print(f"{len(chosen)} queries, {len([c for c in chosen if c in queries.ORACLE])} with SQL, {bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(main())
