"""Every registered query against its SQL counterpart on the smallest tables."""

import os

import pytest

from boardlake.plans import registry
from oracle import connection, differences

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = registry.queries(), registry.oracle_sql()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")


@pytest.fixture(scope="module")
def duck():
    return connection(SF)


@pytest.mark.parametrize("key", list(QUERIES))
def test_query(spark, duck, key):
    rows = QUERIES[key](spark, SF).toPandas()
    assert len(rows.columns) == len(set(rows.columns))
    if key in ORACLES:
        assert differences(rows, duck.execute(ORACLES[key]).df()) is None


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)
