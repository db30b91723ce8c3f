"""Every registered query against its SQL, on the smallest tables or on $ORACLE_SF_DIR."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as registry
from oracle import compare, connect

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
QUERIES = registry.activity_queries()
SQL = {k: v for k, v in registry.oracle_sql().items() if k in QUERIES}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


def test_registry():
    assert set(QUERIES) - set(SQL) == {"risk_evaluation"}
    assert not set(registry.oracle_sql()) - set(registry.queries())


def test_entry(spark):
    assert registry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, connection, name):
    result = QUERIES[name](spark, SF_DIR)
    if name not in SQL:
        assert result.count() > 0
        return
    assert compare(result, SQL[name], connection) == []
