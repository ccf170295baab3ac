"""Every registered engine query against its DuckDB SQL."""

import math

import duckdb
import pytest

from tickloom.plans import queries as E


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else v + 0.0
    return v.isoformat() if hasattr(v, "isoformat") else v


@pytest.fixture(scope="module")
def duck(sf):
    c = duckdb.connect()
    c.sql("SET timezone = 'UTC'")
    c.sql(f"CREATE VIEW events AS SELECT * FROM '{sf[:-5]}0.01/events.parquet'")
    return c


def compare(duck, spark, sf, name):
    df = E.queries()[name](spark, f"{sf[:-5]}0.01")
    relation = duck.sql(E.oracle_sql()[name])
    assert sorted(df.columns) == sorted(relation.columns)
    at = [relation.columns.index(c) for c in df.columns]
    key = lambda r: [(x is None, str(x)) for x in r]
    got = sorted((tuple(map(plain, r)) for r in df.collect()), key=key)
    want = sorted((tuple(plain(r[i]) for i in at) for r in relation.fetchall()), key=key)
    assert got == want


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_oracle(duck, spark, sf, name):
    compare(duck, spark, sf, name)


def test_every_query_has_sql_or_a_test():
    assert set(E.queries()) - set(E.oracle_sql()) == {"fit_transform"}
