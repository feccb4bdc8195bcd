"""Every registered query against its DuckDB oracle at sf0.001 (the driver
runs the same comparison at sf0.01)."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from ledgerflow.plans import catalog  # noqa: E402
from oracle_check import compare, duck  # noqa: E402
from tests.conftest import SF_SMALL  # noqa: E402

QUERIES = E.queries()
SQL = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_of_the_library_has_an_oracle():
    assert set(catalog.QUERIES) <= set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    n_spark, n_oracle, cols_ok, hash_ok, diff = compare(spark, con, SF_SMALL, QUERIES[name], SQL[name])
    assert n_spark == n_oracle and cols_ok and hash_ok, (name, n_spark, n_oracle, diff)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() == 1978
