"""Every registered query runs; those with SQL give the same rows as DuckDB."""

import pytest
from compare import differences, duck

from millrace.plans.catalogue import CHECKS, QUERIES


@pytest.fixture(scope="module")
def con(data):
    return duck(data)


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_same_as_duckdb(spark, data, con, name):
    assert differences(QUERIES[name](spark, data), con, CHECKS[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(CHECKS)))
def test_runs(spark, data, name):
    assert QUERIES[name](spark, data).count() > 0
