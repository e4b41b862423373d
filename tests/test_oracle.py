"""Every registered query against DuckDB over the flat tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as registered
from checks import event_queries, session_queries, storage_queries
from checks.compare import connect, oracle_rows, spark_rows

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


def test_every_query_of_events_has_an_oracle():
    events = event_queries.QUERIES | session_queries.QUERIES | storage_queries.QUERIES
    assert set(events) <= set(registered.queries())
    assert set(events) <= set(registered.oracle_sql()) <= set(registered.queries())


@pytest.mark.parametrize("name", sorted(registered.oracle_sql()))
def test_same_rows(spark, connection, name):
    ours = spark_rows(registered.queries()[name](spark, FOLDER))
    theirs = oracle_rows(connection, registered.oracle_sql()[name])
    assert ours[1]
    assert ours == theirs


def test_entry_is_lazy_and_typed(spark):
    frame = registered.entry(spark)
    assert "session_id" in frame.columns
    assert frame.count() > 0
