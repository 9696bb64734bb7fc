"""Run registered queries against DuckDB on the same tables: ``python -m checks.compare [sf_dir] [name ...]``."""

from __future__ import annotations

import sys
import time

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted((tuple(r[i] for i in order) for r in rows), key=repr)


def compare(con, df, sql):
    """(row count, problem or None)."""
    columns, ours = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return len(ours), None
    result = con.execute(sql)
    names, theirs = rows_of([d[0] for d in result.description], result.fetchall())
    if columns != names:
        return len(ours), f"columns {columns} != {names}"
    if len(ours) != len(theirs):
        return len(ours), f"{len(ours)} rows != {len(theirs)}"
    for a, b in zip(ours, theirs):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return len(ours), f"\n   spark {a}\n   sql   {b}"
    return len(ours), None


def main(argv):
    from checks import registry
    from tenura.session import get_session

    sf = argv[0] if argv else "/root/testdata/sf0.01"
    spark, con = get_session(), connect(sf)
    bad = 0
    for name, query in registry.QUERIES.items():
        if argv[1:] and not any(name.startswith(p) for p in argv[1:]):
            continue
        at = time.time()
        try:
            n, problem = compare(con, query(spark, sf), registry.SQL.get(name))
        except Exception as error:
            n, problem = -1, f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        state = "ok" if problem is None else "BAD"
        print(f"{name:8s} {state:4s} {n:7d} rows {time.time() - at:6.2f}s {'' if name in registry.SQL else 'rows only'} {problem or ''}", flush=True)
    print(f"{bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]) > 0)
