"""Every registered query that has SQL, at the smallest scale."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.compare import connect, difference

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["operator_group", "wells", "median_unit_cost"] and df.count() > 1


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_equals_sql(spark, con, name):
    assert difference(queries()[name], oracle_sql()[name], spark, con, FOLDER) is None
