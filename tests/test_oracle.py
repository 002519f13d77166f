"""Every registered query against its SQL; queries without SQL must at least give rows."""

import compare
import pytest

from mailtally.plans.catalog import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(sf):
    return compare.connect(sf)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, con, name):
    df = QUERIES[name](spark, sf)
    if name in ORACLES:
        assert compare.mismatch(df, con, ORACLES[name]) is None
    else:
        assert df.count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
