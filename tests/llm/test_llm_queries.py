import os

import pytest

from conftest import TESTDATA, compare
from quillmesh.llm import queries

SMALL = f"{TESTDATA}/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test data")


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_gives_the_rows_of_its_sql(spark, name):
    mine, theirs = compare(spark, queries.QUERIES[name], queries.ORACLES[name], SMALL)
    assert mine == theirs


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLES)))
def test_query_without_sql_runs(spark, name):
    assert queries.QUERIES[name](spark, SMALL).count() >= 0
