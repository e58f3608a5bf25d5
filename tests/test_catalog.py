"""Every query against its SQL on the smallest data set."""

import pytest

from oracle import compare, connect
from paperfield.catalog import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    assert compare(spark, con, FOLDER, QUERIES[name], ORACLES.get(name)) is None
