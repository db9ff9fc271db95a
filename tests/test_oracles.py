"""Registered queries against their DuckDB oracles on the smallest tables."""


import duckdb
import pytest

import __spark_entry__ as entry
from strata.plans.registry import ORACLE_SQL, QUERIES
from strata.sources.testdata import TABLES
from tests.conftest import SF_SMALL


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        return f"{v:.6g}"
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    return str(v)


def digest(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted("|".join(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_a_callable_and_oracles_are_a_subset():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(QUERIES) == set(ORACLE_SQL) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(entry.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows) == digest(ocols, orows)


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["state_id", "delivery_date", "num_orders"]
    assert df.count() > 0
