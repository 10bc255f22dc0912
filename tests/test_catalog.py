"""Every registered query gives what its SQL statement gives on the same tables."""

import pytest

import __spark_entry__ as entry_points
from weirgate.catalog import ORACLE, QUERIES
from tests.compare import DEFAULT_DIR, connect, difference



@pytest.fixture(scope="module")
def duck():
    return connect(DEFAULT_DIR)


def test_every_query_has_a_statement():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_points.queries()) and set(ORACLE) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, duck):
    assert difference(QUERIES[name](spark, DEFAULT_DIR), duck, ORACLE[name]) is None


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.columns == ["_source_id", "_source_hash", "user_id", "event_type", "ts", "k"]
    assert df.count() > 0
