import numpy as np
import pytest
from pyspark.sql import functions as F

from quillmesh.operators import clustering
from quillmesh.operators.neighbours import Tree


def cloud(n, dims, seed=0):
    """Uneven groups, repeated points and strays."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dims)) * rng.choice([0.05, 0.3, 1.0], n)[:, None] + rng.integers(0, 3, (n, dims)) * 4.0
    x[rng.integers(0, n, n // 5)] = x[rng.integers(0, n, n // 5)]
    x[: n // 20] = x[0]
    return x


def reachability(x, k):
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    core = np.sort(d, axis=1)[:, k - 1]
    return core, np.maximum(np.maximum(d, core[:, None]), core[None])


def spanning_lengths(m):
    """Prim's, over the full matrix."""
    best, left, lengths = m[0].copy(), np.ones(len(m), dtype=bool), []
    left[0] = False
    while left.any():
        i = np.flatnonzero(left)[best[left].argmin()]
        lengths.append(best[i])
        left[i] = False
        best = np.minimum(best, m[i])
    return np.sort(lengths)


@pytest.mark.parametrize("dims", [1, 3, 12])
def test_nearest_points_are_those_of_the_full_matrix(dims):
    x = cloud(900, dims)
    tree = Tree(x)
    assert sorted(tree.order) == list(range(len(x)))
    core, _ = reachability(x, 7)
    got = np.concatenate([tree.nearest(leaf, 7)[1][:, -1] for leaf in range(tree.leaves)])
    assert np.allclose(got, core[tree.order], atol=1e-9)


@pytest.mark.parametrize(("dims", "k"), [(1, 4), (3, 1), (3, 10), (12, 5)])
def test_spanning_tree_is_that_of_the_full_matrix(spark, dims, k):
    x = cloud(700, dims, seed=k)
    tree = Tree(x)
    found = [tree.nearest(leaf, k) for leaf in range(tree.leaves)]
    near, core = np.vstack([p for p, _ in found]), np.concatenate([d[:, -1] for _, d in found])
    d, a, b = clustering._spanning_tree(spark, tree, spark.sparkContext.broadcast(tree), near, core, 3)
    _, m = reachability(x, k)
    assert len(d) == len(x) - 1 and np.allclose(np.sort(d), spanning_lengths(m), atol=1e-9)
    assert np.allclose(d, m[tree.order[a], tree.order[b]], atol=1e-9)


def test_search_leaves_out_far_leaves(monkeypatch):
    x = np.random.default_rng(3).random((20_000, 3))
    tree, compared = Tree(x), []
    plain = Tree.chunks

    def counted(self, leaves, gap):
        for those, least in plain(self, leaves, gap):
            compared.append(len(those))
            yield those, least

    monkeypatch.setattr(Tree, "chunks", counted)
    for leaf in range(tree.leaves):
        tree.nearest(leaf, 10)
    assert sum(compared) < 0.2 * tree.leaves * len(x)


def test_density_clusters_of_more_points_than_all_pairs_allow(spark):
    """The three cubes of 70,000 points each come out whole; all pairs of 210,000 points were refused."""
    at = lambda d: F.pmod(F.xxhash64(F.lit(d), "id"), F.lit(1000)) / 5000.0
    p = spark.range(210_000).select("id", F.array(at(0) + (F.col("id") % 3) * 10, at(1), at(2)).alias("vector"))
    got = clustering.hdbscan(p, "id", 10).groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.countDistinct(F.col("id") % 3).alias("cubes"))
    assert sorted((r.n, r.cubes) for r in got.collect()) == [(70_000, 1)] * 3


def test_equal_points_are_one_cluster(spark):
    rows = [(i, [1.0, 2.0]) for i in range(200)] + [(1000 + i, [5.0, float(i % 7) / 100]) for i in range(60)]
    got = clustering.hdbscan(spark.createDataFrame(rows, "id bigint, vector array<double>"), "id", 20, 5).collect()
    assert len({r.label for r in got if r.id < 1000}) == 1 and {r.label for r in got if r.id < 1000}.isdisjoint({r.label for r in got if r.id >= 1000})
    assert all(0 <= r.probability <= 1 for r in got) and -1 not in {r.label for r in got if r.id < 1000}


@pytest.mark.parametrize(("bad", "what"), [([1.0, float("nan")], "finite"), ([1.0, None], "finite"), ([1.0], "coordinates")])
def test_vectors_that_have_no_distance_are_an_error(spark, bad, what):
    p = spark.createDataFrame([(0, [0.0, 0.0]), (1, bad), (2, [3.0, 4.0])], "id bigint, vector array<double>")
    with pytest.raises(ValueError, match=what):
        clustering.hdbscan(p, "id", 2, 2)
