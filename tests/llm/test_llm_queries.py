"""The registered corpus queries: all are there, and those with SQL equal it on whole tables."""

import pytest

from __spark_entry__ import queries as registered
from checks.compare import compare, connect
from variantloom.llm.oracle import oracle_sql

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_one_query_for_each_operator_and_the_pipeline():
    names = set(registered())
    numbers = sorted(int(n[2:].split("_")[0]) for n in names if n.startswith("op") and n[2].isdigit())
    assert numbers == list(range(1, 14)) and "pipeline" in names


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, con, name):
    assert compare(spark, con, SF, registered()[name], oracle_sql()[name]) is None
