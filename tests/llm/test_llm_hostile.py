"""Every training-data query runs over tables without rows, and over tables with rows of nulls, repeated rows and further columns."""

import os

import pytest

import hostile
from conftest import TESTDATA
from quillmesh.llm import queries

SMALL = f"{TESTDATA}/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test data")


@pytest.fixture(scope="session", params=["empty", "nulls"])
def tables(request, spark, tmp_path_factory):
    return request.param, hostile.write(spark, SMALL, str(tmp_path_factory.mktemp(request.param)), request.param)


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query_survives(spark, tables, name):
    kind, folder = tables
    rows = queries.QUERIES[name](spark, folder).collect()
    if kind == "empty":
        assert rows == [] or name == "p9_shares"
