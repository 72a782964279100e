"""Every registered query against its SQL twin on the smallest tables."""

import pytest
from oracle_check import compare, connect

from tallyloom.catalog import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, sf_dir, name):
    if name in ORACLES:
        assert compare(spark, con, name, QUERIES[name], ORACLES[name], sf_dir) is None
    else:
        assert QUERIES[name](spark, sf_dir).count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
