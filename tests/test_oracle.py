"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
import compare
from rillstream import plans

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return compare.oracle(SF_DIR)


@pytest.mark.parametrize("name", sorted(plans.QUERIES))
def test_query_agrees_with_sql(spark, con, name):
    problem, _ = compare.difference(spark, con, name, SF_DIR)
    assert problem == ""


def test_entry_runs(spark):
    assert entry.entry(spark).limit(1).count() == 1


def test_every_query_has_an_oracle():
    assert set(plans.ORACLES) == set(plans.QUERIES)
    assert set(plans.QUERIES) <= set(entry.queries())
