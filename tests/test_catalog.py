"""Every registered query against its SQL on whole tables of the smallest size."""

import os

import pytest

import __spark_entry__ as entry
from compare import compare, oracle

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
SLOW_WITHOUT_SQL = {"location_features", "tuned_valuation", "random_forest_search", "stacked_learners", "boosting_search"}


@pytest.fixture(scope="module")
def con():
    return oracle(SF_DIR)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, con, name):
    assert compare(entry.queries()[name](spark, SF_DIR), con, entry.oracle_sql()[name]) == []


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql()) - SLOW_WITHOUT_SQL))
def test_query_without_sql_has_rows(spark, name):
    assert entry.queries()[name](spark, SF_DIR).count() > 0


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0


def test_names_match():
    assert set(entry.oracle_sql()) <= set(entry.queries())
