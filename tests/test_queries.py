from __future__ import annotations

import pytest

import __spark_entry__ as driver
from palabre.plans.oracles import ORACLES
from palabre.plans.queries import QUERIES
from tests.oracle import SF_DIR, compare

# The smallest tables have no product of that price.
MAY_BE_EMPTY = {"products_min_price"}


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(driver.queries()) and set(ORACLES) <= set(driver.oracle_sql())


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_matches_sql(spark, key):
    rows = compare(spark, SF_DIR, QUERIES[key], ORACLES[key])
    assert rows > 0 or key in MAY_BE_EMPTY


def test_entry(spark):
    assert driver.entry(spark).count() == 200
