"""Every registered query against its SQL, and rules that hold for every plan."""

import re

import pytest
from helpers import SMALL, plan

import compare
from __spark_entry__ import entry
from oracle.sql import oracle_queries
from salesmill.registry import build_queries

# The warehouse's own queries; those of the training-data operators are tested beside them.
QUERIES = build_queries()


@pytest.fixture(scope="module")
def con():
    return compare.connect(SMALL)


def test_every_query_has_sql():
    assert sorted(QUERIES) == sorted(oracle_queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_equals_sql(spark, con, name):
    """The rows are right, and the plan needs neither a cross join nor Python."""
    df = QUERIES[name](spark, SMALL)
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin|EvalPython|InPandas|InArrow", plan(df))
    assert compare.difference(df, con, name) is None


def test_entry(spark):
    assert entry(spark).count() == 10
