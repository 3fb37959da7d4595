"""Every registered query against its DuckDB SQL on the driver's tables (sf0.001)."""

import os

import pytest
from compare import compare, duck

import __spark_entry__ as E
from histlens.plans.registry import queries

SF = os.environ.get("HISTLENS_TEST_SF", "/root/testdata/sf0.001")
NAMES = sorted(queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_oracle_or_is_listed():
    missing = set(queries()) - set(E.oracle_sql())
    assert not missing, missing


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    sql = E.oracle_sql().get(name)
    if sql is None:
        assert df.count() >= 0
        return
    ok, msg = compare(df, con, sql)
    assert ok, msg


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert len(df.columns) == 45
    assert df.count() > 0
