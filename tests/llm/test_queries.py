"""Every operator's query against its SQL, on the smallest tables or on $ORACLE_SF_DIR."""

from __future__ import annotations

import os

import pytest

from cellpulse.llm.queries import QUERIES, SQL
from oracle import compare, connect

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, name):
    assert compare(QUERIES[name](spark, SF_DIR), SQL[name], connect(SF_DIR)) == []
