"""Every query against its SQL, on the smallest given tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry
from check_oracle import compare, oracle_connection

from tidemark.plans.catalog import QUERIES

NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con(small):
    return oracle_connection(small)


def test_every_query_has_sql():
    assert set(NAMES) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, con, small, name):
    assert compare(spark, con, name, small) == ""


def test_entry_returns_months(spark):
    assert entry.entry(spark).count() == 80
