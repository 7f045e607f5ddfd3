from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry
from tessera.plans import record_queries, registry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in record_queries.TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def plain(v):
    return round(v, 9) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    df = registry.queries()[name](spark, SF)
    cursor = duck.execute(registry.oracle_sql()[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == sorted(df.columns)
    order = [names.index(c) for c in df.columns]
    want = sorted(repr(tuple(plain(r[i]) for i in order)) for r in cursor.fetchall())
    assert sorted(repr(tuple(map(plain, r))) for r in df.collect()) == want


def test_every_query_has_sql():
    assert set(registry.queries()) == set(registry.oracle_sql())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(registry.queries()) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())
