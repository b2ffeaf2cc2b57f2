"""Registered queries against their SQL at the smallest scale."""

import os

import pytest

import __spark_entry__ as entry
from compare import connect, difference

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()
# The operators of training data have tests of their own.
NAMES = [n for n in QUERIES if not n.startswith(("op", "pipeline"))]

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_sql_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, con, name):
    got = QUERIES[name](spark, FOLDER).toPandas()
    if name in ORACLES:
        assert difference(got, con.execute(ORACLES[name]).df()) is None
    else:
        assert len(got)


def test_entry(spark):
    assert entry.entry(spark).count() == 40
