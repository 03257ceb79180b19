import pytest

from compare import compare, duck
from conftest import SF as SMALL
from reviewmill.llm import queries

SF = SMALL.replace("sf0.001", "sf0.01")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, con, name):
    problem, _ = compare(queries.QUERIES[name](spark, SF), con, queries.ORACLES[name])
    assert problem is None
