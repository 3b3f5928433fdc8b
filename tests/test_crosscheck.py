"""Every registered query against its SQL twin, on whole tables of the smallest data set."""

import os

import pytest
from crosscheck import compare, connect

from isopleth.plans import catalog

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_query(spark, con, name):
    df = catalog.QUERIES[name](spark, SF)
    assert compare(df, con, catalog.ORACLES[name]) is None


def test_every_query_has_its_twin():
    assert set(catalog.QUERIES) == set(catalog.ORACLES)
