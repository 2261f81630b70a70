"""Every registered query against its DuckDB oracle text on the sf0.001 tables."""

import pytest

from hearth.registry import ORACLE, QUERIES
from tests.oracle_compare import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, QUERIES[name], ORACLE.get(name), SF)
    assert r.get("ok") is not False, r


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


def test_entry_smoke(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.count() >= 0
    assert len(df.columns) == 21
