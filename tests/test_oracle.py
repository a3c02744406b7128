import pytest

import __spark_entry__
from checks.compare import difference, duck
from checks.oracle import ORACLE
from checks.queries import QUERIES
from tests.conftest import SF


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_its_sql(spark, con, name):
    assert difference(spark, con, SF, name) is None


def test_every_query_has_sql_and_the_entry_runs(spark):
    assert QUERIES.keys() == ORACLE.keys()
    assert QUERIES.keys() <= __spark_entry__.queries().keys()
    assert ORACLE.keys() <= __spark_entry__.oracle_sql().keys()
    assert __spark_entry__.entry(spark).count() > 0
