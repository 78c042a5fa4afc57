"""Every registered query against its SQL, on the whole tables of the smallest scale."""

import os

import pytest
from oracle import connect, difference

from vectable.plans import ORACLE, QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, con, name):
    assert difference(spark, SF, QUERIES[name], ORACLE[name], con) == ""


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_has_rows(spark, name):
    assert QUERIES[name](spark, SF).count() > 0
