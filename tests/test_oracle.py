"""Every registered query against its SQL on the smallest tables."""

import pytest

from registry.oracle import ORACLE
from registry.spark_queries import QUERIES
from tests.compare import difference, views

SF = "/root/testdata/sf0.001"


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.fixture(scope="module")
def con():
    return views(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, con, name):
    assert difference(QUERIES[name](spark, SF), con, ORACLE[name]) is None
