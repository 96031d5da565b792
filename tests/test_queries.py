"""Every registered query against its SQL answer."""

import pytest
from compare import assert_same
from conftest import MEDIUM, SMALL

import __spark_entry__ as contract
from torquelake.oracles import oracle_sql
from torquelake.queries import registered_queries

QUERIES, ORACLES = registered_queries(), oracle_sql()


def test_every_query_has_an_answer():
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, name):
    folder = SMALL if name.startswith("stream_") else MEDIUM
    assert_same(QUERIES[name](spark, folder), ORACLES[name], folder)


def test_entry(spark):
    assert contract.entry(spark).count() == 906
