"""Every registered query vs its DuckDB oracle on the smallest driver tables."""

import pytest

import oracle
from conftest import SF_SMALL

import __spark_entry__ as E

NAMES = sorted(E.queries())


@pytest.fixture(scope="module")
def con():
    return oracle.duck(SF_SMALL)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    sql = E.oracle_sql().get(name)
    df = E.queries()[name](spark, SF_SMALL)
    if sql is None:
        assert df.count() >= 0
        return
    res = oracle.compare(df, sql, con)
    assert res["ok"], res


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "rolling_12m_turnover_rate" in df.columns
