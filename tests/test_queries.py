"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
import check

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return check.connect(SF_DIR)


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query(spark, connection, name):
    ok, message, _, _ = check.compare(spark, connection, name, SF_DIR)
    assert ok, message
    assert "types" not in message


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
