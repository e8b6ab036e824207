"""Run registered queries in Spark and DuckDB and compare their rows.

    python -m tests.check_oracle [--sf DIR] [name ...]
"""

from __future__ import annotations

import argparse
import datetime
import decimal
import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def plain(value):
    """A comparable form that keeps the kind of the value apart."""
    if isinstance(value, float):
        return ("nan",) if math.isnan(value) else ("num", value)
    if isinstance(value, bool):
        return ("bool", value)
    if isinstance(value, int):
        return ("int", value)
    if isinstance(value, decimal.Decimal):
        return ("dec", str(value))
    if isinstance(value, datetime.datetime):
        return ("ts", value.replace(tzinfo=None).isoformat())
    if isinstance(value, datetime.date):
        return ("date", value.isoformat())
    if isinstance(value, (list, tuple)):
        return ("list", tuple(plain(v) for v in value))
    if isinstance(value, dict):
        return ("map", tuple((k, plain(v)) for k, v in value.items()))
    return value


def bag(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def spark_rows(df):
    return df.columns, [tuple(r) for r in df.collect()]


def duck_rows(con, sql):
    result = con.execute(sql)
    return [c[0] for c in result.description], result.fetchall()


def compare(spark, con, sf_dir, entry) -> str | None:
    """None when both engines agree, else what differs."""
    columns, rows = spark_rows(entry.build(spark, sf_dir))
    duck_columns, duck_found = duck_rows(con, entry.sql)
    if sorted(columns) != sorted(duck_columns):
        return f"columns {columns} and {duck_columns}"
    mine, theirs = bag(columns, rows), bag(duck_columns, duck_found)
    if mine != theirs:
        return (
            f"{len(rows)} and {len(duck_found)} rows; only Spark {list((mine - theirs).items())[:3]}; "
            f"only SQL {list((theirs - mine).items())[:3]}"
        )
    return None if rows else "no rows"


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()

    from curate.registry import entries
    from tests.conftest import local_session

    spark, con, failed = local_session(), duck(args.sf), 0
    for name, entry in entries().items():
        if args.names and name not in args.names:
            continue
        start = time.time()
        try:
            problem = compare(spark, con, args.sf, entry)
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += problem is not None
        print(f"{name:28s} {time.time() - start:6.2f}s  {problem or 'equal'}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main())
