"""The queries that have SQL, on whole tables."""

import pytest
from cases import SF
from compare import connect, difference
from loomwire.llm.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def db():
    return connect(SF)


@pytest.mark.parametrize("name", ORACLES)
def test_same_rows(spark, db, name):
    assert difference(QUERIES[name](spark, SF), db, ORACLES[name]) is None
