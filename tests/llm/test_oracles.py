"""Queries with SQL against DuckDB on a test folder."""

from pathlib import Path

import pytest

from estatelake.llm.queries import ORACLE
from tests.check_queries import compare, duck

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")
@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    assert compare(spark, duck(FOLDER), name, FOLDER) == ""
