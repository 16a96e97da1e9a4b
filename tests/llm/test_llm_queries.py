"""The registered queries against DuckDB where SQL can say the same, else that they return all rows."""

import pytest
from compare import differences, duck

from millrace.llm.queries import CHECKS, QUERIES


@pytest.fixture(scope="module")
def con(data):
    return duck(data)


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_same_as_duckdb(spark, data, con, name):
    assert differences(QUERIES[name](spark, data), con, CHECKS[name]) == []


def test_all_operators():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_entry_registers_all():
    import __spark_entry__

    assert set(QUERIES) | {"pipeline"} <= set(__spark_entry__.queries())
    assert set(CHECKS) <= set(__spark_entry__.oracle_sql())
