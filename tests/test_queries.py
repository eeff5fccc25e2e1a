"""Every query with a DuckDB twin gives the twin's rows; the others give rows."""

import pytest
from compare import connect, difference

from skillweave.plans import registry

QUERIES, ORACLES = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.fixture(scope="module")
def sf_dir():
    return "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    if name in ORACLES:
        assert difference(df, duck, ORACLES[name]) is None
    else:
        assert df.count() > 0
