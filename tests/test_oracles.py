"""Every registered query against its DuckDB oracle, on the smallest test data."""

import pytest

import __spark_entry__ as entry
from checks import ORACLES, QUERIES
from checks.compare import connect, difference


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", QUERIES)
def test_matches_oracle(spark, duck, sf_dir, name):
    assert difference(QUERIES[name](spark, sf_dir), duck, ORACLES[name]) is None
