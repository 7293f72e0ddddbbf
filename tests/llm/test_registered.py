"""Every registered query of the subpackage: against its SQL, or its shape."""

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from morrowcart.llm.queries import ORACLE_SQL, QUERIES
from oracle_compare import compare, duck


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_all_are_registered():
    assert {k for k in E.queries() if k.startswith("op")} - {"offline_eval"} == set(QUERIES)
    assert "pipeline" in E.queries()
    assert [k.split("_")[0] for k in QUERIES] == [f"op{i}" for i in range(1, len(QUERIES) + 1)]


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_matches_sql(spark, con, name):
    r = compare(spark, con, QUERIES[name], ORACLE_SQL[name], SF_SMALL)
    assert r["ok"], r
