"""Every registered query against its SQL on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from workload.oracles import ORACLES
from workload.queries import QUERIES
from tests.check_queries import difference, duck

SF_DIR = os.environ.get("GRADLAKE_TEST_DATA", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", list(entry.oracle_sql()))
def test_query(spark, con, name):
    found = entry.queries()[name](spark, SF_DIR).toPandas()
    assert len(found) > 0
    assert difference(found, con.execute(entry.oracle_sql()[name]).df()) is None


def test_entry(spark):
    assert entry.entry(spark).count() == 1


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
