"""Every registered query against its SQL oracle on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry_point
from contract.oracle import oracle
from contract.queries import registry
from tests.compare import connect, difference

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLE = registry(), oracle()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables absent")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_its_oracle():
    assert set(ORACLE) == set(QUERIES)
    assert set(QUERIES) <= set(entry_point.queries()) and set(entry_point.oracle_sql()) <= set(entry_point.queries())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_oracle(spark, con, name):
    assert difference(QUERIES[name](spark, SF_DIR), con, ORACLE[name]) is None


def test_entry(spark):
    frame = entry_point.entry(spark)
    assert frame.columns == ["jour", "fuel_id", "fuel", "prix_median", "nombre_stations"]
    assert frame.count() == 115
