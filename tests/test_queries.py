"""Every registered query against its SQL on the smallest test tables."""

import pytest

import __spark_entry__ as entry
from standins import catalogue
from tests.compare import differences, duck
from tests.conftest import SF

QUERIES, ORACLES = catalogue.queries(), dict(catalogue.ORACLES)
EMPTY: set[str] = set()  # queries that may return nothing


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    assert differences(QUERIES[name](spark, SF), con, ORACLES[name]) is None
    assert name in EMPTY or con.execute(f"select count(*) from ({ORACLES[name]})").fetchone()[0] > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
