"""Every registered query against its SQL on the small tables."""

import pytest

import __spark_entry__ as entry
from check import compare, connect


@pytest.fixture(scope="module")
def db(folder):
    return connect(folder)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query_matches_oracle(spark, db, folder, name):
    assert compare(spark, db, name, folder) == ""


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert rows and set(rows[0].asDict()) == {"query_id", "rank", "doc_id", "score"}


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
