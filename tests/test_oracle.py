import pytest

from __spark_entry__ import entry
from __spark_entry__ import queries as registered
from checks.compare import compare, connect
from checks.oracle import oracle_sql
from checks.queries import queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql():
    assert set(queries()) == set(oracle_sql())
    assert set(queries()) <= set(registered())


@pytest.mark.parametrize("name", list(queries()))
def test_query_equals_sql(spark, con, name):
    assert compare(spark, con, SF, queries()[name], oracle_sql()[name]) is None


def test_entry_has_rows(spark):
    assert entry(spark).count() > 0
