"""Differential test: every registered query against its DuckDB oracle."""

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from morrowcart.plans import oracle, registry
from oracle_compare import compare, duck

ORACLE = oracle.build()
KEYS = list(registry.QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(KEYS) == set(ORACLE) <= set(E.queries())
    assert len(KEYS) == 71


@pytest.mark.parametrize("name", KEYS)
def test_matches_oracle(spark, con, name):
    r = compare(spark, con, registry.QUERIES[name], ORACLE[name], SF_SMALL)
    assert r["ok"], r


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() == 326
    assert len(df.columns) == 431
