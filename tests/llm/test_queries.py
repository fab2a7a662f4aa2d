"""The queries with SQL next to DuckDB."""

import pytest

from check import compare, oracle_connection
from relayframe.llm.queries import ORACLE, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    assert compare(spark, oracle_connection(SF_DIR), SF_DIR, name) is None


def test_one_query_for_each_operator():
    assert [int(n[2:].split("_")[0]) for n in QUERIES] == list(range(1, 1 + len(QUERIES)))
