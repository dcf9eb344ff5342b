"""Every catalogue query equals its DuckDB oracle on the smallest driver tables."""

from __future__ import annotations

import math

import duckdb
import pytest

import __spark_entry__ as E
from fulcrum.plans.catalog import QUERIES
from fulcrum.plans.oracle import QUERIES_SQL
from tests.conftest import SF_SMALL

TABLES = "region nation customer supplier part orders lineitem documents".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def _norm(v):
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    return v


def _sort_key(row):
    return tuple((x is None, "" if x is None else x) for x in row)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(QUERIES_SQL) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    cols = df.columns
    got = sorted((tuple(_norm(r[c]) for c in cols) for r in df.collect()), key=_sort_key)
    rel = duck.execute(QUERIES_SQL[name])
    dcols = [d[0] for d in rel.description]
    assert sorted(cols) == sorted(dcols)
    idx = [dcols.index(c) for c in cols]
    want = sorted((tuple(_norm(r[i]) for i in idx) for r in rel.fetchall()), key=_sort_key)
    assert got == want


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert df.columns == [
        "supplier_id", "orders", "revenue", "freight", "late_rate", "cancel_rate", "bad_review_rate",
        "freight_burden", "demand_volatility", "revenue_share", "risk_score", "risk_quintile",
    ]
