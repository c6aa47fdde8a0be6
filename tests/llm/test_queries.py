"""Queries of the corpus operators against their SQL."""

import os

import duckdb
import pytest

from sparkhunt.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


def norm(value):
    return round(float(value), 9) if isinstance(value, (int, float)) and not isinstance(value, bool) else value


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"create view {table} as select * from '{FOLDER}/{table}.parquet'")
    df = QUERIES[name](spark, FOLDER)
    want = con.execute(ORACLES[name])
    names = [d[0] for d in want.description]
    assert sorted(df.columns) == sorted(names)
    got = counted(df.select(*names).collect())
    assert got == counted(want.fetchall())


def counted(rows):
    from collections import Counter

    return Counter(tuple(map(norm, r)) for r in rows)


def test_there_is_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_nothing_else_imports_the_package():
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    for top in ("sparkhunt", "queryset"):
        for folder, _, files in os.walk(os.path.join(root, top)):
            if os.path.join("sparkhunt", "llm") in folder:
                continue
            for name in (f for f in files if f.endswith(".py")):
                assert "sparkhunt.llm" not in open(os.path.join(folder, name)).read()
