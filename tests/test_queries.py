"""Every registered query against its SQL."""

import pytest

import __spark_entry__ as registry
from activity_lake.queries import QUERIES as OWN
from tests.oracle import SF_DIR, assert_same, connect

QUERIES = {name: query for name, query in registry.queries().items() if name in OWN}
ORACLES = registry.oracle_sql()


@pytest.fixture(scope="module")
def connection():
    return connect()


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(OWN) <= set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, connection, name):
    assert assert_same(QUERIES[name](spark, SF_DIR), connection, ORACLES[name]) > 0


def test_entry(spark, connection):
    assert_same(registry.entry(spark), connection, ORACLES["change_stream_count"])
