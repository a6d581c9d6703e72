"""Every registered query against the same answer in SQL, on whole tables."""

import pytest
from oracle import compare, connect

from __spark_entry__ import entry, oracle_sql, queries
from tallymart.plans.oracle import all_oracles
from tallymart.plans.registered import all_queries


@pytest.fixture(scope="module")
def database(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query_matches_sql(spark, sf_dir, database, name):
    assert compare(all_queries()[name](spark, sf_dir), database, all_oracles()[name]) > 0


def test_every_query_has_sql():
    assert set(all_queries()) == set(all_oracles())
    assert set(all_queries()) <= set(queries())
    assert set(oracle_sql()) <= set(queries())


def test_entry_runs(spark):
    assert entry(spark).count() > 0
