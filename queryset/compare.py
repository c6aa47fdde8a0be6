"""Run registered queries on Spark and their SQL on DuckDB and compare the results.

Usage: python -m queryset.compare FOLDER [name ...]
"""

from __future__ import annotations

import datetime
import math
import sys
import time

import duckdb

from queryset.views import TABLES


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else (0.0 if value == 0 else value)
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if isinstance(value, datetime.datetime) and value.tzinfo:
        return value.astimezone(datetime.timezone.utc).replace(tzinfo=None)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted(repr([plain(r[i]) for i in order]) for r in rows)


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return con


def kinds(columns, types):
    simple = {"bigint": "long", "int64": "long", "integer": "int", "int32": "int", "hugeint": "huge"}
    return {n: simple.get(str(t).lower(), str(t).lower()) for n, t in zip(columns, types)}


def compare(spark, con, folder: str, name: str) -> str | None:
    """None when both results agree, else what differs."""
    from queryset import ORACLES, QUERIES

    df = QUERIES[name](spark, folder)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if name not in ORACLES:
        return None
    cur = con.execute(ORACLES[name])
    names = [d[0] for d in cur.description]
    want = rows_of(names, cur.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} <> {want[0]}"
    if got[1] != want[1]:
        extra = [r for r in got[1] if r not in set(want[1])][:3]
        missing = [r for r in want[1] if r not in set(got[1])][:3]
        return f"rows {len(got[1])} / {len(want[1])}\n   spark {extra}\n   duckdb {missing}"
    return None


def main(argv: list[str]) -> int:
    from queryset import ORACLES, QUERIES
    from sparkhunt.session import build_session

    folder, chosen = argv[0], argv[1:] or list(QUERIES)
    spark = build_session(
        "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "16g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(folder), 0
    for name in chosen:
        start = time.time()
        try:
            problem = compare(spark, con, folder, name)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:700]}"
        bad += problem is not None
        kind = "exact" if name in ORACLES else "rows"
        print(f"{'FAIL' if problem else 'ok  '} {name} ({kind}) {time.time() - start:.1f}s", flush=True)
        if problem:
            print("  ", problem[:1500], flush=True)
    print(f"{len(chosen) - bad} of {len(chosen)} agree")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
