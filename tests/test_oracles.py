"""Every registered query against its SQL on the smallest tables."""

import os

import pytest

from check_oracles import compare, connect
from __spark_entry__ import entry, oracle_sql, queries

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, con, name):
    assert compare(spark, con, name, SF_DIR) is None


def test_entry(spark):
    assert entry(spark).columns == ["state", "particles"]


def test_oracles_belong_to_queries():
    assert set(oracle_sql()) <= set(queries())
