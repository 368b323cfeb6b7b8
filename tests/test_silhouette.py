import numpy as np

from quillmesh.plans import registry


def test_silhouette_query_measures_all_points_up_to_the_default_sample(spark, tmp_path):
    """The points with the highest ids are the worst; the query counts them as brute force does."""
    rng = np.random.default_rng(2)
    labels = np.arange(600) % 3
    points = rng.normal(size=(600, 4)) + 3.0 * labels[:, None] + np.where(np.arange(600) < 300, 0.0, rng.normal(scale=6.0, size=600))[:, None]
    rows = [(i, [float(x) for x in v], int(c)) for i, (v, c) in enumerate(zip(points, labels, strict=True))]
    spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    distance = np.sqrt(((points[:, None] - points[None]) ** 2).sum(2))
    each = []
    for i in range(600):
        means = [distance[i, labels == c].sum() / ((labels == c).sum() - (c == labels[i])) for c in range(3)]
        a, b = means[labels[i]], min(m for c, m in enumerate(means) if c != labels[i])
        each.append((b - a) / max(a, b))
    got = {n: registry.queries()[n](spark, str(tmp_path)).first().silhouette for n in ("stratified_silhouette", "stratified_silhouette_default")}
    assert abs(got["stratified_silhouette_default"] - np.mean(each)) < 1e-5 < abs(got["stratified_silhouette"] - np.mean(each))
