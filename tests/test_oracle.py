"""The driver's gate at the smallest scale: every registered query vs DuckDB."""

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from oracle_compare import compare, duck

SQLS = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_query_matches_oracle(spark, con, name):
    info = compare(spark, con, name, E.queries()[name], SQLS.get(name), SF_SMALL)
    assert info["ok"] in (True, None), info


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[0] == "h3_index"
