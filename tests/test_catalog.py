"""Every registered query against its SQL, on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry

from . import oracle

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF_DIR)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    if name in ORACLES:
        assert oracle.compare(spark, con, SF_DIR, QUERIES[name], ORACLES[name]) == ""
    else:
        assert QUERIES[name](spark, SF_DIR).count() > 0


def test_entry(spark):
    assert entry.entry(spark).limit(1).count() == 1
