"""Every registered query against DuckDB on the smallest tables."""

import compare
import pytest

import __spark_entry__
from runlens.plans import bindings

FOLDER = "/root/testdata/sf0.001"
QUERIES = bindings.queries()
ORACLES = bindings.oracles()


@pytest.fixture(scope="module")
def duck():
    return compare.connect(FOLDER)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    assert compare.difference(QUERIES[name](spark, FOLDER), duck, ORACLES[name]) == ""


def test_every_query_is_registered():
    assert set(QUERIES) <= set(__spark_entry__.queries())


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() == 10
