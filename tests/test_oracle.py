"""Every query against its SQL in DuckDB, on whole tables."""

import pytest

import __spark_entry__ as entry
from compare import connect, difference

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", entry.oracle_sql())
def test_same_rows(spark, db, name):
    assert difference(entry.queries()[name](spark, SF_DIR), db, entry.oracle_sql()[name]) is None


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql())))
def test_rows_only(spark, name):
    assert entry.queries()[name](spark, SF_DIR).count() > 0


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
