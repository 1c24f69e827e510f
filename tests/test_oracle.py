"""Every registered query that SQL can express, against SQL; the others must run and give rows."""

import pytest
from compare import compare, connect

from tallyloom.plans import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(name, spark, con):
    assert compare(QUERIES[name], ORACLES[name], spark, FOLDER, con) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - {"ward"}))
def test_gives_rows(name, spark):
    assert QUERIES[name](spark, FOLDER).count() > 0
