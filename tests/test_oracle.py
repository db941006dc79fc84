"""Every registered query beside its DuckDB text, at the smallest scale."""

import pytest

from tests.oracle import compare, connect
from thalweg.catalog import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("key", [k for k in QUERIES if k in ORACLES])
def test_matches_oracle(spark, con, sf, key):
    _, problem = compare(spark, con, QUERIES[key], ORACLES[key], sf)
    assert problem is None


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
