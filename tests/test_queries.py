"""Every catalogue query against its SQL twin, on whole tables."""

import os

import pytest

import __spark_entry__ as contract
from oracle_check import compare, duck
from skytide.plans.catalog import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables here")


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    assert compare(spark, con, SF_DIR, contract.queries()[name], contract.oracle_sql()[name]) is None


def test_every_query_has_sql():
    assert set(QUERIES) <= set(contract.queries())
    assert set(QUERIES) <= set(contract.oracle_sql())


def test_flagship(spark):
    df = contract.entry(spark)
    assert df.count() > 0
    assert df.columns == ["objectId", "month", "band", "n_detections", "n_limits", "y_max"]
