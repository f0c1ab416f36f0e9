"""Registered queries against their SQL on the smallest tables."""

import os

import pytest
from oracle import compare, connect

from foliograph.plans.catalogue import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not mounted")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, con, name):
    assert compare(QUERIES[name](spark, SF), con, ORACLE[name]) == ""


def test_every_sql_has_a_query():
    assert set(ORACLE) <= set(QUERIES)
