import numpy as np
import pytest
from pyspark.sql import functions as F

from quillmesh.operators import clustering, discovery, features, merge, rdf
from quillmesh.streaming import stages


def blobs(spark, sizes, dims=4, spread=0.1, seed=0):
    rng = np.random.default_rng(seed)
    rows, n = [], 0
    for label, size in enumerate(sizes):
        for v in rng.normal(size=(size, dims)) * spread + np.eye(dims)[label % dims] * 10:
            rows.append((n, [float(x) for x in v], label))
            n += 1
    return spark.createDataFrame(rows, "id bigint, vector array<double>, label int")


def agree(truth, found):
    pairs = {(truth[k], found[k]) for k in truth}
    return len(pairs) == len({t for t, _ in pairs}) == len({f for _, f in pairs})


def test_hdbscan_finds_blobs_and_noise(spark):
    p = blobs(spark, [40, 60, 50])
    far = spark.createDataFrame([(1000 + i, [100.0 * (i + 2), -50.0 * i, 7.0, 0.0], -1) for i in range(4)] + [(2000, None, -1)], p.schema)
    got = {r.id: r.label for r in clustering.hdbscan(p.unionByName(far).drop("label"), "id", 20, 5, block_rows=32).collect()}
    truth = {r.id: r.label for r in p.collect()}
    assert agree(truth, {k: got[k] for k in truth}) and all(got[1000 + i] == -1 for i in range(4)) and 2000 not in got


def test_hdbscan_limits(spark):
    p = blobs(spark, [5]).drop("label")
    assert {r.label for r in clustering.hdbscan(p, "id", 20, 5).collect()} == {-1}
    assert clustering.hdbscan(p.limit(0), "id").count() == 0
    with pytest.raises(ValueError, match="at most"):
        clustering.hdbscan(p, "id", most_points=3)


def test_run_separates_templates(spark):
    rng = np.random.default_rng(1)
    rows = []
    for family in range(3):
        for i in range(15):
            tokens = {f"f{family}.t{j}": int(rng.integers(1, 9)) for j in range(12)} | {"html": 1, f"noise{rng.integers(5)}": 1}
            rows.append((family * 100 + i, tokens))
    df = features.token_counts(spark.createDataFrame(rows, "id bigint, tokens map<string,int>"), "id")
    for config in (clustering.Config(algorithm="kmeans", k=3, seeds=3, components=4), clustering.Config(min_cluster_size=8, min_samples=3, components=4)):
        done, m = clustering.run(df, "id", config)
        got = {r.id: r.label for r in done.collect()}
        assert agree({k: k // 100 for k in got}, got) and m["n_clusters"] == 3 and m["silhouette"] > 0.5 and 0 < m["explained_variance"] <= 1
    with pytest.raises(ValueError, match="records"):
        clustering.run(df, "id", clustering.Config())


def test_measures_against_brute_force(spark):
    p = blobs(spark, [8, 9, 7], spread=3.0)
    rows = p.collect()
    x, l = np.array([r.vector for r in rows]), np.array([r.label for r in rows])
    d = np.linalg.norm(x[:, None] - x[None], axis=2)
    s = []
    for i in range(len(l)):
        a = d[i][(l == l[i]) & (np.arange(len(l)) != i)].mean()
        b = min(d[i][l == o].mean() for o in set(l) - {l[i]})
        s.append((b - a) / max(a, b))
    assert abs(clustering.silhouette(p, "id").first()[0] - np.mean(s)) < 1e-9
    assert clustering.silhouette(p.where("label = 0"), "id").first()[0] is None
    c = {k: x[l == k].mean(0) for k in set(l)}
    best = {k: rows[np.flatnonzero(l == k)[np.linalg.norm(x[l == k] - c[k], axis=1).argmin()]].id for k in c}
    assert {r.label: r.medoid for r in clustering.medoids(p, "id").collect()} == best
    picked = {r.label: r.n for r in clustering.stratified(p, "id", sample=6, floor=3).groupBy("label").agg(F.count("*").alias("n")).collect()}
    assert picked == {0: 3, 1: 3, 2: 3}


def test_svd_keeps_distances(spark):
    rows = [(i, f"t{j}", float((i * 7 + j * 3) % 5 + 1)) for i in range(12) for j in range(6)]
    v, kept, _ = clustering.svd(spark.createDataFrame(rows, "id bigint, token string, weight double"), "id", 5)
    got = {r.id: np.array(r.vector) for r in v.collect()}
    m = np.array([[float((i * 7 + j * 3) % 5 + 1) for j in range(6)] for i in range(12)])
    u, s, _ = np.linalg.svd(m, full_matrices=False)
    z = u[:, :5] * s[:5]
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    for i in range(12):
        assert abs(np.linalg.norm(got[i] - got[0]) - np.linalg.norm(z[i] - z[0])) < 1e-6
    assert 0.9 < kept <= 1.000001


def test_tfidf_fails_without_tokens(spark):
    with pytest.raises(ValueError, match="min_df"):
        features.tfidf(spark.createDataFrame([(1, "a", 1)], "id int, token string, count int"), "id", 2)


def test_site_from_a_corpus(spark):
    urls = spark.createDataFrame([(f"https://memearchive.example/memes/events/e{i}",) for i in range(3)] + [("https://memearchive.example/memes/x",), ("https://memearchive.example/memes/trending",)], "url string")
    site = discovery.infer_site(urls)
    assert site.patterns[0] == ("/memes/events/", "memes/events") and ("/memes/trending", False) in site.listings
    assert discovery.infer_site(urls.limit(0)) == discovery.DEFAULT_SITE
    assert type(site).from_json(site.to_json()) == site


def test_sitemap_tree_with_a_loop(spark):
    children = spark.createDataFrame([("a", "b"), ("b", "a"), ("b", "c"), ("x", "y"), ("a", None)], "parent string, child string")
    assert {r.loc for r in discovery.sitemap_tree(spark.createDataFrame([("a",), ("a",), (None,)], "loc string"), children).collect()} == {"a", "b", "c"}


def test_rdf_shape(spark):
    t = spark.createDataFrame([("a", "p", "1"), ("a", "p", "2"), ("b", "p", "1"), ("a", "q", "1"), ("c", "r", "1"), ("c", "p", "1"), ("d", "p", "1"), ("d", "r", "2")], "s string, p string, o string")
    got = {r.p: (r.share, r.least, r.most, r.everywhere) for r in rdf.shape(t, 0.3).collect()}
    assert got == {"p": (1.0, 1, 2, True), "r": (0.5, 1, 1, False)}
    assert rdf.shape(t.limit(0)).count() == 0


def test_stream_merge_survives_a_repeated_start(spark, tmp_path):
    for n, rows in enumerate([[(1, "a", 1)], [(2, "a", 5), (3, "b", 1)]]):
        spark.createDataFrame(rows, "seq int, k string, v int").write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema("seq int, k string, v int").parquet(str(tmp_path / "in"))
        table = merge.VersionedTable(spark, str(tmp_path / "t"))
        for _ in range(2):
            stages.merge_stream(stream, table, "k", {"v": merge.added}, ["seq"], str(tmp_path / "c")).awaitTermination()
        assert table.version() == n + 2
    assert {r.k: r.v for r in table.read().collect()} == {"a": 6, "b": 1}


def test_stream_dedup_and_sessions(spark, tmp_path):
    rows = [("2026-01-01 00:00:00", "a"), ("2026-01-01 00:00:05", "a"), ("2026-01-01 00:10:00", "b"), ("2026-01-01 05:00:00", "z")]
    spark.createDataFrame(rows, "ts string, k string").withColumn("ts", F.col("ts").cast("timestamp")).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("ts timestamp, k string").parquet(str(tmp_path / "in"))
    for name, df in (("d", stages.deduplicated(stream, ["k"], "ts", "1 hour")), ("s", stages.sessions(stream, "ts", "1 minute", "1 minute", "k"))):
        df.writeStream.format("parquet").option("path", str(tmp_path / name)).option("checkpointLocation", str(tmp_path / f"{name}c")).trigger(availableNow=True).start().awaitTermination()
    assert spark.read.parquet(str(tmp_path / "d")).count() == 3
    assert {(r.k, r.n) for r in spark.read.parquet(str(tmp_path / "s")).collect()} == {("a", 2), ("b", 1)}


def test_assign_new_points(spark):
    p = blobs(spark, [10, 10])
    c = clustering.centroids(p)
    far = spark.createDataFrame([(99, [500.0, 500.0, 0.0, 0.0], 0)], p.schema)
    got = {r.id: r.label for r in clustering.assign(p.unionByName(far), "id", c, 5.0).collect()}
    assert all(got[r.id] == r.label for r in p.collect()) and got[99] == clustering.NOISE
