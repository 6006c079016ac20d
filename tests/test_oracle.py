"""Every query with SQL agrees with DuckDB; the others give rows."""

import os

import pytest
from compare import compare, connect

import __spark_entry__ as entry

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
# No group reaches the smallest number of samples for a fit at the smallest scale.
NEED_MORE_ROWS = {"predict_per_group"}
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    found = [tuple(r) for r in df.collect()]
    if name in ORACLES:
        assert compare(df.columns, found, duck, ORACLES[name]) is None
    else:
        assert df.columns and (found or name in NEED_MORE_ROWS)


def test_entry(spark):
    assert entry.entry(spark).limit(5).count() == 5


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
