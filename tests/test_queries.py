import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from lexivane import plans
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.001"

NAMES = list(plans.QUERIES)


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
@pytest.mark.parametrize("name", NAMES)
def test_query_against_sql(spark, con, name):
    if name in oracle_sql():
        assert compare(spark, con, SF, queries()[name], oracle_sql()[name]) is None
    else:
        assert queries()[name](spark, SF).count() > 0


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
def test_entry(spark):
    assert entry(spark).count() > 0
