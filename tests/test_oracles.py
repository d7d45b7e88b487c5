"""Every registered query of the library against its SQL, on the smallest tables."""

import os

import pytest

from tessella.plans import QUERIES, SQL

from .oracle import connect, difference

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="the given tables are not here")
@pytest.mark.parametrize("name", sorted(SQL))
def test_rows_equal_those_of_the_sql(spark, con, name):
    assert difference(spark, con, QUERIES[name], SQL[name], SF_DIR) is None
