"""Compare registered queries with their SQL in DuckDB, ignoring row order.

    python -m tests.oracle [sf0.01] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from datetime import date, datetime
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def plain(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, datetime):
        return value.replace(tzinfo=None)
    if isinstance(value, date):
        return datetime(value.year, value.month, value.day)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6) + 0.0
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([tuple(plain(r[i]) for i in order) for r in rows], key=repr)


def compare(spark, con, fn, sql: str, sf_dir: str) -> tuple[str | None, int]:
    """First difference, or None, and the number of rows."""
    df = fn(spark, sf_dir)
    ours = rows_of(df.columns, df.collect())
    relation = con.execute(sql)
    names = [d[0] for d in relation.description]
    theirs = rows_of(names, relation.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}", len(ours)
    if len(ours) != len(theirs):
        return f"rows {len(ours)} != {len(theirs)}", len(ours)
    for a, b in zip(ours, theirs):
        if a != b:
            return f"{a} != {b}", len(ours)
    return None, len(ours)


def main() -> None:
    sys.path.insert(0, ".")
    from __spark_entry__ import oracle_sql, queries
    from revrec.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "sf0.01"
    wanted = sys.argv[2:]
    sf_dir = f"/root/testdata/{sf}"
    spark, con = build_session("oracle", "8"), connect(sf_dir)
    bad = 0
    for name, fn in queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        sql = oracle_sql().get(name)
        try:
            if sql is None:
                difference, n = None, len(fn(spark, sf_dir).collect())
            else:
                difference, n = compare(spark, con, fn, sql, sf_dir)
        except Exception as e:  # report and go on with the other queries
            difference, n = f"{type(e).__name__}: {str(e)[:600]}", -1
        bad += difference is not None
        state = "rows-only" if sql is None else "ok"
        print(f"{name:28s} {n:8d} {time.time() - start:6.1f}s {difference or state}", flush=True)
    print("differences:", bad)


if __name__ == "__main__":
    main()
