"""Every query with a SQL counterpart, value by value, on the smallest tables."""

import pytest
from compare import DATA, connect, difference

from riskgrid.queries.oracle import ORACLES
from riskgrid.queries.registry import QUERIES

SF = f"{DATA}/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_oracle_has_a_query():
    assert not set(ORACLES) - set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, name):
    assert difference(QUERIES[name](spark, SF), con, ORACLES[name]) is None
