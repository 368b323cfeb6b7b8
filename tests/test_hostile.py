"""Every core query runs over tables without rows, and over tables with rows of nulls, repeated rows and further columns."""

import os

import pytest

import hostile
from conftest import TESTDATA
from quillmesh.plans import registry

SMALL = f"{TESTDATA}/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test data")
#: Clustering refuses too few records, features refuse a collection without tokens, a namespace filter a name that fits nothing.
REFUSE_EMPTY = {"svd_cosines", "model_assign", "kmeans_blobs", "template_clusters", "cluster_sweep", "token_tfidf", "structure_tfidf", "top_tokens", "kmeans_embeddings", "namespace_prefix_filter"}


@pytest.fixture(scope="session", params=["empty", "nulls"])
def tables(request, spark, tmp_path_factory):
    return request.param, hostile.write(spark, SMALL, str(tmp_path_factory.mktemp(request.param)), request.param)


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query_survives(spark, tables, name):
    kind, folder = tables
    if kind == "empty" and name in REFUSE_EMPTY:
        with pytest.raises(Exception):  # noqa: B017
            registry.queries()[name](spark, folder).count()
    else:
        registry.queries()[name](spark, folder).write.format("noop").mode("overwrite").save()
