"""Every registered query against its SQL, on the smallest tables."""

import pytest

import __spark_entry__ as spark_entry
import sql_check
from millrace.plans.queries import QUERIES
from oracles import ORACLES


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, sf_dir, name):
    ok, note = sql_check.compare(spark, sf_dir, name)
    assert ok, note


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry_runs(spark):
    assert spark_entry.entry(spark).count() > 0
