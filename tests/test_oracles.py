import pytest

from somatiq.plans.catalogue import ORACLES, QUERIES

from .oracle import assert_same, connect


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, sf, name):
    assert_same(QUERIES[name](spark, sf).toPandas(), connect(sf).execute(ORACLES[name]).df())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_gives_rows(spark, sf, name):
    assert QUERIES[name](spark, sf).limit(5).count() > 0
