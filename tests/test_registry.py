"""Every registered query against its SQL oracle on the smallest test set."""

import datetime as dt

import duckdb
import pytest

import __spark_entry__ as E
from conftest import TESTDATA

KEYS = sorted(E.oracle_sql())
TABLES = ("events", "lineitem", "documents", "pages", "benchmark", "conversations", "embeddings")


def norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return repr(v)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return repr(v)


def canon(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{TESTDATA}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle_or_is_listed():
    from tripyard.plans import registry

    assert set(registry.queries()) == set(registry.oracle_sql())


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "total_trips" in df.columns


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    df = E.queries()[key](spark, TESTDATA)
    cur = con.execute(E.oracle_sql()[key])
    o_names = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(o_names)
    assert canon(df.columns, df.collect()) == canon(o_names, cur.fetchall())
