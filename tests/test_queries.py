"""Every registered query against its SQL equivalent."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import compare, oracle_connection

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return oracle_connection(SF_DIR)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_sql(spark, connection, name):
    assert compare(spark, connection, SF_DIR, name) is None


def test_entry_has_the_chunk_columns(spark):
    assert entry(spark).columns == ["topic", "bucket", "partition", "min_offset", "max_offset", "n_rows"]


def test_own_queries_have_sql():
    from workload.oracle import ORACLE
    from workload.queries import all_queries

    assert set(all_queries()) == set(ORACLE)
    assert set(ORACLE) <= set(queries())
