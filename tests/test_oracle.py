"""Every registered query against its SQL on the test tables."""

import os

import pytest
from compare import compare, connect

import __spark_entry__ as driver
from tastegrid.plans.catalog import QUERIES
from tastegrid.plans.oracle import ORACLE

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def oracle():
    return connect(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, oracle, name):
    compare(driver.queries()[name](spark, SF_DIR), oracle, driver.oracle_sql()[name])


def test_entry_returns_rows(spark):
    assert driver.entry(spark).count() == 10


ORDERED = {
    "item_avg_rating": ["item_id"],
    "users_low_balance": ["user_id"],
    "users_segment_range": ["user_id"],
    "ratings_in_order": ["user_id", "item_id", "rating", "ts"],
    "favourite_genre_counts": ["favorite_genre"],
    "recommend_top5": ["user_id", "rank"],
    "most_excluded_items": ["item_id"],
}


@pytest.mark.parametrize("name", sorted(ORDERED))
def test_rows_come_in_the_order_of_the_sql(spark, oracle, name):
    columns = ORDERED[name]
    got = [tuple(row) for row in QUERIES[name](spark, SF_DIR).select(*columns).collect()]
    want = oracle.sql(ORACLE[name]).select(", ".join(columns)).fetchall()
    assert got == want
