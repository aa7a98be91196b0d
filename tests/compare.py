"""Runs registered queries and their SQL side by side: python -m tests.compare <data folder> [name prefix ...]"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def value(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 4)
    return v


def bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(value(r[i]) for i in order) for r in rows)


def differences(spark, con, query, sql: str, sf_dir: str) -> list[str]:
    df = query(spark, sf_dir)
    got = bag(df.columns, df.collect())
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = bag(names, cur.fetchall())
    if sorted(df.columns) != sorted(names):
        return [f"columns {sorted(df.columns)} <> {sorted(names)}"]
    out = []
    if sum(got.values()) != sum(want.values()):
        out.append(f"rows {sum(got.values())} <> {sum(want.values())}")
    if got != want:
        out.append(f"spark only {list((got - want).items())[:2]}")
        out.append(f"sql only {list((want - got).items())[:2]}")
    return out


def main() -> int:
    import __spark_entry__ as entry
    from bench import session

    sf_dir, prefixes = sys.argv[1], tuple(sys.argv[2:])
    spark, con = session(8), connect(sf_dir)
    sqls, failed = entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if prefixes and not name.startswith(prefixes):
            continue
        started = time.time()
        if name not in sqls:
            print(f"{name}: rows {query(spark, sf_dir).count()} (no SQL) {time.time() - started:.1f}s", flush=True)
            continue
        try:
            found = differences(spark, con, query, sqls[name], sf_dir)
        except Exception as e:
            found = [f"{type(e).__name__}: {str(e)[:600]}"]
        failed += bool(found)
        print(f"{name}: {'ok' if not found else found} {time.time() - started:.1f}s", flush=True)
    print("failed", failed)
    return failed


if __name__ == "__main__":
    sys.exit(main())
