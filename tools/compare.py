"""Run registered queries against their SQL oracles: python tools/compare.py [sf dir] [name ...]"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time
from decimal import Decimal

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from keystrata.catalogue import ORACLES, QUERIES  # noqa: E402
from keystrata.session import local_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, Decimal):
        return format(value, "f")
    if isinstance(value, (dt.date, dt.datetime)):
        return value.isoformat()
    return repr(value)


def oracle_connection(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return con


def difference(got, con, sql: str) -> str | None:
    """None when both sides agree on column names, types of values and the multiset of rows."""
    names = sorted(got.columns)
    rows = sorted(tuple(plain(r[c]) for c in names) for r in got.collect())
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    if sorted(columns) != names:
        return f"columns {names} != {sorted(columns)}"
    order = [columns.index(c) for c in names]
    expected = sorted(tuple(plain(r[i]) for i in order) for r in result.fetchall())
    if len(rows) != len(expected):
        return f"{len(rows)} rows != {len(expected)}"
    for mine, theirs in zip(rows, expected):
        if mine != theirs:
            return f"{names}\n   spark  {mine}\n   oracle {theirs}"[:1500]
    kinds = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "date": "DATE", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}
    types = dict(con.execute(f"select column_name, column_type from (describe ({sql}))").fetchall())
    off = [
        f"{f.name}: {f.dataType.simpleString()} / {types[f.name]}"
        for f in got.schema.fields
        if kinds.get(f.dataType.simpleString(), f.dataType.simpleString().upper()) != types[f.name]
    ]
    return f"types differ: {', '.join(off)}" if off else None


def main() -> int:
    args = sys.argv[1:]
    folder = args.pop(0) if args and "/" in args[0] else "/root/testdata/sf0.01"
    spark = local_session(8)
    con = oracle_connection(folder)
    failed = 0
    for name, build in QUERIES.items():
        if args and name not in args:
            continue
        start = time.time()
        try:
            df = build(spark, folder)
            if name in ORACLES:
                problem = difference(df, con, ORACLES[name])
            else:
                problem = None if df.collect() else "no rows"
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {error}"[:1500]
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
