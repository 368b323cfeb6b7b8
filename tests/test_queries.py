"""Every core query runs over the smallest tables; those with SQL give its rows."""

import os

import pytest

from conftest import TESTDATA, compare
from quillmesh.plans import registry

SMALL = f"{TESTDATA}/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test data")


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_gives_the_rows_of_its_sql(spark, name):
    mine, theirs = compare(spark, registry.queries()[name], registry.oracle_sql()[name], SMALL)
    assert mine == theirs


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(registry.oracle_sql())))
def test_query_without_sql_runs(spark, name):
    df = registry.queries()[name](spark, SMALL)
    assert df.columns and df.count() >= 0


def test_every_oracle_has_a_query():
    assert set(registry.oracle_sql()) <= set(registry.queries())
