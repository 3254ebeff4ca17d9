"""Every registered query against its SQL on the smallest tables, read whole."""

import os

import pytest

import __spark_entry__ as entry
from tools.check_oracle import compare, connect

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables not available")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_has_sql():
    from strataflow.workloads import REGISTRY
    assert set(REGISTRY) <= set(entry.oracle_sql())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(entry.REGISTRY))
def test_query(spark, con, name):
    assert compare(spark, con, name, FOLDER)
