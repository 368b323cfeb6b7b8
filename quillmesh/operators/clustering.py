"""Clustering of embeddings and its measures: truncated SVD, k-means, density clustering, silhouette, Davies-Bouldin, medoids."""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillmesh.operators import features, neighbours
from quillmesh.operators.frequency import join_salted
from quillmesh.operators.select import numbered
from quillmesh.session import Workspace

NOISE = -1
#: Nearest points of each point that are kept while its spanning tree grows.
LISTED = 16


def unit(v: Column) -> Column:
    """An array scaled to length 1; a zero vector stays."""
    length = F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x))
    return F.transform(v, lambda x: F.when(length > 0, x / length).otherwise(x.cast("double")))


def _sparse_rows(w: DataFrame, ids: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """i, j, x: the weights of each record as one sparse row. Tokens that all records have are dealt out over parts."""
    counts = w.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    placed = join_salted(w, ids, "token", counts).join(rows, key)
    packed = placed.groupBy("i").agg(F.array_sort(F.collect_list(F.struct("j", "weight"))).alias("v"))
    return packed.select("i", F.col("v.j").alias("j"), F.col("v.weight").alias("x"))


def svd(weights: DataFrame, key: str, components: int) -> tuple[DataFrame, float, DataFrame]:
    """(key, vector: the truncated SVD of the records' token weights, uncentred, scaled to length 1; share of the variance kept; token, factor:
    the way of each token into the reduced space).

    components is cut to one less than records and tokens, and is 2 at least. The token side of the factors, tokens x components, comes to
    the driver; min_df bounds the tokens beforehand. A record's vector is the sum of its tokens' factors times their weights,
    computed where the rows are."""
    from pyspark.mllib.linalg import Vectors
    from pyspark.mllib.linalg.distributed import RowMatrix

    spark = weights.sparkSession
    work = Workspace(spark, "svd")
    # Rows that repeat a key and token add up.
    w = work.write(weights.groupBy(key, "token").agg(F.sum("weight").alias("weight")), "weights")
    ids = work.write(numbered(w.select("token").distinct(), ["token"], "j"), "vocabulary")
    rows = work.write(numbered(w.select(key).distinct(), [key], "i"), "rows")
    n, m = rows.count(), ids.count()
    k = max(2, min(components, n - 1, m - 1))
    # MLlib takes an RDD of vectors; one vector for each record passes through Python, no token does.
    packed = work.write(_sparse_rows(w, ids, rows, key), "packed")
    matrix = RowMatrix(packed.rdd.map(lambda r: Vectors.sparse(m, r["j"], r["x"])), 0, m)
    v = matrix.computeSVD(k, computeU=False).V.toArray()
    factors = spark.createDataFrame(pd.DataFrame({"j": np.arange(m), "factor": [row.tolist() for row in v]}), "j bigint, factor array<double>")
    factors = work.write(factors.join(ids, "j").select("token", "factor"), "factors")
    reduced = work.write(projected(w, factors, key), "reduced")
    kept = reduced.select(F.posexplode("v").alias("d", "x")).groupBy("d").agg(F.var_pop("x").alias("v")).agg(F.sum("v")).first()[0]
    whole = w.groupBy("token").agg(F.sum("weight").alias("s"), F.sum(F.col("weight") * F.col("weight")).alias("q")).agg(F.sum(F.col("q") / n - (F.col("s") / n) ** 2)).first()[0]
    return reduced.select(key, unit(F.col("v")).alias("vector")), float(kept / whole) if whole else 0.0, factors


def projected(weights: DataFrame, factors: DataFrame, key: str) -> DataFrame:
    """key, v: the sum of the tokens' factors times their weights; tokens without a factor don't count, records without any are left out."""
    counts = weights.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    parts = join_salted(weights.select(key, "token", "weight"), factors, "token", counts)
    long = parts.select(key, F.posexplode(F.transform("factor", lambda x: x * F.col("weight"))).alias("d", "x")).groupBy(key, "d").agg(F.sum("x").alias("x"))
    return long.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("d", "x"))).alias("v")).select(key, F.col("v.x").alias("v"))


@dataclass
class Model:
    """What a run knows that new records need to find their cluster: of each token its idf and factor, and of each cluster its centroid and
    the greatest distance of a member from it. Kept as tables in one folder."""

    tokens: DataFrame
    centres: DataFrame
    binary: bool = True

    def save(self, path: str) -> None:
        self.tokens.write.mode("overwrite").parquet(f"{path}/tokens")
        self.centres.write.mode("overwrite").parquet(f"{path}/centres")
        self.tokens.sparkSession.createDataFrame([(self.binary,)], "binary boolean").coalesce(1).write.mode("overwrite").parquet(f"{path}/parameters")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Model:
        return cls(spark.read.parquet(f"{path}/tokens"), spark.read.parquet(f"{path}/centres"), spark.read.parquet(f"{path}/parameters").first()[0])

    def project(self, tokens: DataFrame, key: str) -> DataFrame:
        """key, vector of records (key, token, count) in the space of the run; records without a known token are left out."""
        tf = F.lit(1.0) if self.binary else 1.0 + F.log("count")
        counts = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
        raw = join_salted(tokens.select(key, "token", "count"), self.tokens.select("token", "idf"), "token", counts).withColumn("w", tf * F.col("idf"))
        length = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(key)))
        return projected(raw.select(key, "token", (F.col("w") / length).alias("weight")), self.tokens.select("token", "factor"), key).select(key, unit(F.col("v")).alias("vector"))

    def assign(self, tokens: DataFrame, key: str) -> DataFrame:
        """key, label, distance of new records: the cluster with the nearest centroid, NOISE beyond the farthest member of that cluster."""
        found = assign(self.project(tokens, key), key, self.centres).join(F.broadcast(self.centres.select("label", "most")), "label")
        return found.select(key, F.when(F.col("distance") <= F.col("most") + 1e-9, F.col("label")).otherwise(NOISE).alias("label"), "distance")


def kmeans(points: DataFrame, key: str, k: int, seeds: int = 10, seed: int = 42) -> DataFrame:
    """key, label of the best of several runs by cost. points: key, vector (array)."""
    data = points.where("vector is not null").select(key, array_to_vector(F.col("vector").cast("array<double>")).alias("features")).persist()
    try:
        models = [KMeans(k=k, seed=seed + s, featuresCol="features", predictionCol="label").fit(data) for s in range(seeds)]
        best = min(models, key=lambda m: m.summary.trainingCost)
        return Workspace(points.sparkSession, "kmeans").write(best.transform(data).select(key, "label"), "labels")
    finally:
        data.unpersist()


def hdbscan(points: DataFrame, key: str, min_cluster_size: int = 100, min_samples: int = 10, most_points: int = 5_000_000, block_rows: int = 2048) -> DataFrame:
    """key, label, probability: density clusters; NOISE with probability 0 for points of none.

    Core distances - to the min_samples-th nearest point, itself counted - and the spanning tree of mutual reachability are exact. The points,
    a matrix of 8 bytes for each coordinate, are put in the order of a k-d tree on the driver and broadcast; tasks of block_rows points at least
    search the leaves that can hold a nearer point (neighbours.py). The tree comes from Boruvka rounds: each component takes its shortest edge
    to another. In many dimensions boxes rule out little and the search is quadratic. The tree, one row for each point, is condensed
    on the driver, so more than most_points points are an error; clusters are taken by excess of mass, never a single one. Points with
    equal keys count once, null vectors are left out; vectors of unequal length or with coordinates that aren't finite are an error.
    """
    spark = points.sparkSession
    work = Workspace(spark, "hdbscan")
    clean = work.write(points.where(f"vector is not null and `{key}` is not null").select(key, F.col("vector").cast("array<double>").alias("vector")).dropDuplicates([key]), "points")
    total = clean.count()
    if total > most_points:
        raise ValueError(f"{total} points; density clustering takes {most_points} at most")
    key_type = clean.schema[key].dataType.simpleString()
    if total == 0:
        return clean.select(key, F.lit(NOISE).alias("label"), F.lit(0.0).alias("probability"))
    rows = clean.orderBy(key).toArrow()  # most_points rows at most
    keys = rows[key]
    tree = neighbours.Tree(_matrix(rows["vector"]))
    del rows
    parts = max(1, min(-(-total // block_rows), 4 * spark.sparkContext.defaultParallelism, tree.leaves))
    k = min(min_samples, total)
    placed = spark.sparkContext.broadcast(tree)

    def nearest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tree = placed.value
        for b in batches:
            for part in b["id"]:
                found = [tree.nearest(leaf, k) for leaf in range(part, tree.leaves, parts)]
                near, core = np.vstack([p[:, :LISTED] for p, _ in found]), np.concatenate([d[:, -1] for _, d in found])
                yield pd.DataFrame({"part": [part], "near": [near.astype(np.int32).tobytes()], "core": [core.tobytes()]})

    near, core = np.empty((total, min(k, LISTED)), dtype=np.int32), np.empty(total)
    for r in spark.range(0, parts, 1, parts).mapInPandas(nearest, "part bigint, near binary, core binary").toArrow().to_pylist():
        own = np.concatenate([np.arange(tree.starts[leaf], tree.starts[leaf + 1]) for leaf in range(r["part"], tree.leaves, parts)])
        near[own], core[own] = np.frombuffer(r["near"], dtype=np.int32).reshape(len(own), -1), np.frombuffer(r["core"])
    d, a, b = _spanning_tree(spark, tree, placed, near, core, parts)
    placed.unpersist()
    x, y = np.minimum(tree.order[a], tree.order[b]), np.maximum(tree.order[a], tree.order[b])
    del tree, near, core, a, b
    by = np.lexsort((y, x, d))
    labels, probability = condense(d[by], x[by], y[by], total, min_cluster_size)
    out = pa.table({key: keys, "label": pa.array(labels, pa.int32()), "probability": pa.array(probability, pa.float64())})
    return work.write(spark.createDataFrame(out, f"`{key}` {key_type}, label int, probability double"), "labels")


def _matrix(vectors: pa.ChunkedArray) -> np.ndarray:
    """The vectors as rows; of no coordinates, as one of 0."""
    lengths = vectors.combine_chunks().value_lengths().unique().to_pylist()
    if len(lengths) > 1:
        raise ValueError(f"vectors of {min(lengths)} and of {max(lengths)} coordinates")
    if lengths == [0]:
        return np.zeros((len(vectors), 1))
    rows = np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in vectors.chunks]).reshape(len(vectors), -1)
    if not np.isfinite(rows).all():
        raise ValueError("vectors with coordinates that aren't finite")
    return rows


def _spanning_tree(spark: SparkSession, tree: neighbours.Tree, placed: Broadcast, near: np.ndarray, core: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """d, a, b of the edges of a minimum spanning tree by mutual reachability, between places of the k-d tree. near: the places of some of each
    point's nearest; the shortest of these edges that leaves a component bounds what is looked for. A point whose core distance is
    no less than the bound can't have a shorter one."""
    links = np.empty(near.shape)
    for at in range(0, len(near), 16384):
        own = slice(at, at + 16384)
        apart = np.sqrt(((tree.points[near[own]] - tree.points[own][:, None]) ** 2).sum(axis=2))
        links[own] = np.maximum(np.maximum(apart, core[own][:, None]), core[near[own]])
    cores = spark.sparkContext.broadcast(core)
    component, count = np.arange(len(core)), len(core)
    open_rows = np.arange(len(core))  # those with a listed neighbour in another component
    edges: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    while count > 1:
        d = np.where(component[near[open_rows]] != component[open_rows][:, None], links[open_rows], np.inf)
        j = d.argmin(axis=1)
        d = d[np.arange(len(j)), j]
        some = np.isfinite(d)
        open_rows, j, d = open_rows[some], j[some], d[some]
        best, length = neighbours.shortest(component[open_rows], np.arange(len(j)), d, count)
        a = np.where(best >= 0, open_rows[best] if len(j) else -1, -1)
        b = np.where(best >= 0, near[open_rows[best], j[best]] if len(j) else -1, -1)
        if (core < length[component]).any():
            state = spark.sparkContext.broadcast((component.astype(np.int32), length))

            def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
                tree, core, (component, length) = placed.value, cores.value, state.value
                for batch in batches:
                    for part in batch["id"]:
                        yield pd.DataFrame(dict(zip("cabd", tree.outgoing(range(part, tree.leaves, parts), core, component, length), strict=True)))

            found = spark.range(0, parts, 1, parts).mapInPandas(search, "c bigint, a bigint, b bigint, d double").toArrow()
            state.unpersist()
            c, fa, fb, fd = (found[x].to_numpy() for x in "cabd")
            best, shorter = neighbours.shortest(c, np.arange(len(c)), fd, count)
            nearer = np.flatnonzero(best >= 0)
            a[nearer], b[nearer], length[nearer] = fa[best[nearer]], fb[best[nearer]], shorter[nearer]
        own = np.flatnonzero(a >= 0)
        by = own[np.lexsort((np.maximum(tree.order[a[own]], tree.order[b[own]]), np.minimum(tree.order[a[own]], tree.order[b[own]]), length[own]))]
        component, taken = neighbours.joined(component, a[by], b[by], count)
        edges.append((length[by][taken], a[by][taken], b[by][taken]))
        count -= len(edges[-1][0])
    cores.unpersist()
    none = (np.empty(0), np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64))
    return tuple(np.concatenate(x) for x in zip(none, *edges, strict=True))


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((a**2).sum(1)[:, None] + (b**2).sum(1)[None, :] - 2 * a @ b.T, 0.0))


def condense(d: np.ndarray, x: np.ndarray, y: np.ndarray, n: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Labels and probabilities from the edges of a spanning tree in the order of their length: merges of fewer than `least` points on one side
    are points falling out of a cluster; a cluster is kept if its own excess of mass is at least that of the clusters within it."""
    parent = array("q", range(2 * n - 1))
    left, right, size = (array("q", bytes(8 * (2 * n - 1))) for _ in range(3))
    for i in range(n):
        size[i] = 1
    for new, (a, b) in enumerate(zip(x.tolist(), y.tolist(), strict=True), n):
        while parent[a] != a:
            parent[a] = a = parent[parent[a]]
        while parent[b] != b:
            parent[b] = b = parent[parent[b]]
        left[new], right[new], size[new] = a, b, size[a] + size[b]
        parent[a] = parent[b] = new
    rate = array("d", np.divide(1.0, d, out=np.full(len(d), np.inf), where=d > 0).tobytes())
    # The cluster from which each node falls and the rate at which it does; -1 where it doesn't fall as a whole.
    home, fall = array("q", bytes(8 * (2 * n - 1))), array("d", [-1.0]) * (2 * n - 1)
    born, of = [0.0], [-1]
    stack = [(2 * n - 2, 0)]
    while stack:
        node, c = stack.pop()
        if node < n:
            home[node], fall[node] = c, np.inf
            continue
        lam, sides = rate[node - n], (left[node], right[node])
        if size[sides[0]] >= least and size[sides[1]] >= least:
            for s in sides:
                stack.append((s, len(born)))
                born.append(lam)
                of.append(c)
        else:
            for s in sides:
                if size[s] >= least:
                    stack.append((s, c))
                else:
                    home[s], fall[s] = c, lam
    for node in range(2 * n - 2, n - 1, -1):
        if (lam := fall[node]) >= 0:
            a, b = left[node], right[node]
            home[a] = home[b] = home[node]
            fall[a] = fall[b] = lam
    own, rates = np.array(home[:n]), np.array(fall[:n])
    birth, up = np.array(born), np.array(of)
    finite = np.concatenate([rates, birth])
    cap = max(finite[np.isfinite(finite)].max(), 0.0) or 1.0
    rates, birth = np.minimum(rates, cap), np.minimum(birth, cap)
    members = np.bincount(own, minlength=len(up))
    for c in range(len(up) - 1, 0, -1):  # those within a cluster have greater numbers
        members[up[c]] += members[c]
    stable = np.bincount(own, weights=rates - birth[own], minlength=len(up)) + np.bincount(up[1:], weights=(birth[1:] - birth[up[1:]]) * members[1:], minlength=len(up))
    inner, kept = np.zeros(len(up)), np.zeros(len(up), dtype=bool)
    for c in range(len(up) - 1, 0, -1):
        kept[c] = inner[c] <= stable[c]
        inner[up[c]] += max(stable[c], inner[c])
    chosen = np.full(len(up), -1)
    for c in range(1, len(up)):
        chosen[c] = chosen[up[c]] if chosen[up[c]] >= 0 else c if kept[c] else -1
    number = np.cumsum(chosen == np.arange(len(up))) - 1
    cluster = chosen[own]
    labels = np.where(cluster >= 0, number[cluster], NOISE)
    most = np.zeros(max(len(up), 1))
    np.maximum.at(most, cluster[cluster >= 0], rates[cluster >= 0])
    top = most[cluster]
    probability = np.where(top > 0, np.round(rates / np.where(top > 0, top, 1.0), 4), 1.0)
    return labels, np.where(cluster >= 0, probability, 0.0)


def centroids(points: DataFrame) -> DataFrame:
    """label, centroid, size of the labelled points that aren't noise. points: label, vector."""
    long = points.where(F.col("label") != NOISE).select("label", F.posexplode(F.col("vector").cast("array<double>")).alias("d", "x"))
    means = long.groupBy("label", "d").agg(F.avg("x").alias("m"), F.count(F.lit(1)).alias("size"))
    return means.groupBy("label").agg(F.array_sort(F.collect_list(F.struct("d", "m"))).alias("c"), F.max("size").alias("size")).select("label", F.col("c.m").alias("centroid"), "size")


def _to(a: Column, b: Column) -> Column:
    return F.sqrt(F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x))


def davies_bouldin(points: DataFrame) -> DataFrame:
    """One row, davies_bouldin: the mean over clusters of the worst ratio of spread to separation; null for fewer than two clusters. The clusters'
    centroids and spreads, a row for each, come to the driver; the points don't."""
    c = Workspace(points.sparkSession, "davies").write(centroids(points), "centroids")
    spread = points.select("label", F.col("vector").cast("array<double>").alias("vector")).join(c, "label").groupBy("label").agg(F.avg(_to(F.col("vector"), F.col("centroid"))).alias("s"))
    rows = spread.join(c.select("label", "centroid"), "label").collect()
    if len(rows) < 2:
        return points.sparkSession.createDataFrame([(None,)], "davies_bouldin double")
    s, m = np.array([r["s"] for r in rows]), np.array([r["centroid"] for r in rows])
    apart = np.sqrt(((m[:, None] - m[None]) ** 2).sum(-1))
    np.fill_diagonal(apart, np.inf)
    worst = ((s[:, None] + s[None]) / apart).max(axis=1)
    return points.sparkSession.createDataFrame([(float(worst.mean()),)], "davies_bouldin double")


def stratified(points: DataFrame, key: str, sample: int = 4000, floor: int = 50, order: Column | None = None) -> DataFrame:
    """A sample in which each cluster has its share of the budget, but `floor` points at least, or all it has. Noise is left out. order: what
    chooses the points of a cluster; a hash of the key unless given."""
    own = points.where(F.col("label") != NOISE)
    sizes = own.groupBy("label").agg(F.count(F.lit(1)).alias("size"))
    n = sizes.agg(F.sum("size")).first()[0] or 0
    quota = sizes.withColumn("take", F.least("size", F.greatest(F.lit(floor), F.bround(F.lit(float(sample)) * F.col("size") / F.lit(float(max(n, 1)))).cast("bigint"))))
    ranked = own.join(F.broadcast(quota), "label")  # a row for each cluster
    if order is not None:
        ranked = ranked.withColumn("__r", F.row_number().over(Window.partitionBy("label").orderBy(order, key)))
        return ranked.where(F.col("__r") <= F.col("take")).drop("__r", "size", "take")
    # By hash the rows that can be among the first are those below a bound that nearly no sample exceeds; where one does, its cluster is ranked whole.
    rank = F.xxhash64(key)
    share = F.least(F.lit(1.0), (F.col("take") + 8 * F.sqrt("take") + 16) / F.col("size"))
    low = (rank / F.lit(2.0**64) + 0.5) < share
    enough = ranked.groupBy("label").agg((F.count_if(low) >= F.max("take")).alias("__enough"))
    likely = ranked.join(F.broadcast(enough), "label").where(low | ~F.col("__enough"))
    likely = likely.withColumn("__r", F.row_number().over(Window.partitionBy("label").orderBy(rank, key)))
    return likely.where(F.col("__r") <= F.col("take")).drop("__r", "size", "take", "__enough")


def silhouette(points: DataFrame, key: str, sample: int = 4000, floor: int = 50, order: Column | None = None) -> DataFrame:
    """One row, silhouette: the mean silhouette (Euclidean) of the stratified sample; null for fewer than two clusters. The sample, whose size the
    parameters bound, is broadcast; each task measures its points against it."""
    picked = Workspace(points.sparkSession, "silhouette").write(stratified(points.select(key, "label", F.col("vector").cast("array<double>").alias("vector")), key, sample, floor, order), "sample")
    rows = picked.select("label", "vector").collect()  # sample + floor for each cluster at most
    ids = sorted({r["label"] for r in rows})
    if len(ids) < 2 or len(rows) <= len(ids) + 1:
        return points.sparkSession.createDataFrame([(None,)], "silhouette double")
    shared = points.sparkSession.sparkContext.broadcast((np.array([r["vector"] for r in rows]), np.array([ids.index(r["label"]) for r in rows]), ids))

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        v, l, ids = shared.value
        sizes = np.bincount(l, minlength=len(ids))
        member = np.eye(len(ids))[l]
        for b in batches:
            if not len(b):
                continue
            own = np.array([ids.index(x) for x in b["label"]])
            sums = _distances(np.array(b["vector"].tolist()), v) @ member
            at = np.arange(len(own))
            a = sums[at, own] / np.maximum(sizes[own] - 1, 1)
            means = sums / sizes
            means[at, own] = np.inf
            other = means.min(axis=1)
            yield pd.DataFrame({"s": np.where(sizes[own] > 1, (other - a) / np.maximum(np.maximum(a, other), 1e-300), 0.0)})

    return picked.select("label", "vector").mapInPandas(measure, "s double").agg(F.avg("s").alias("silhouette"))


def medoids(points: DataFrame, key: str) -> DataFrame:
    """label, medoid, size: of each cluster the point nearest to its centroid, ties by key."""
    j = points.join(centroids(points), "label")
    d = F.round(_to(F.col("vector").cast("array<double>"), F.col("centroid")), 9)
    return j.groupBy("label").agg(F.min_by(key, F.struct(d, F.col(key))).alias("medoid"), F.max("size").alias("size"))


def samples(points: DataFrame, key: str, most: int = 5, seed: int = 42) -> DataFrame:
    """label, samples: the medoid and others chosen by a hash, `most` in all; noise has no medoid. The limit on the rank
    is applied before the shuffle."""
    m = medoids(points, key)
    rest = points.select("label", key).join(F.broadcast(m.select("label", "medoid")), "label", "left")  # a row for each cluster
    first = F.coalesce((F.col(key) == F.col("medoid")).cast("int"), F.lit(0))
    order = Window.partitionBy("label").orderBy(first.desc(), F.xxhash64(F.col(key), F.lit(seed)), key)
    r = rest.withColumn("r", F.row_number().over(order))
    return r.where(F.col("r") <= most).groupBy("label").agg(F.array_sort(F.collect_list(F.struct("r", key))).alias("s")).select("label", F.col(f"s.{key}").alias("samples"))


@dataclass(frozen=True)
class Config:
    """One run; a sweep takes several."""

    algorithm: str = "hdbscan"
    min_cluster_size: int = 100
    min_samples: int = 10
    k: int = 8
    binary: bool = True
    components: int = 30
    min_df: int = 2
    sample: int = 4000
    floor: int = 50
    seeds: int = 10


def reduce_tokens(tokens: DataFrame, key: str, config: Config) -> tuple[DataFrame, float, DataFrame]:
    """(key, vector; share of the variance kept; token, idf, factor) for a configuration's min_df, binary and components."""
    work = Workspace(tokens.sparkSession, "reduced")
    n = tokens.select(key).distinct().count()
    weights = work.write(features.tfidf(tokens, key, config.min_df, config.binary), "weights")
    points, kept, factors = svd(weights, key, config.components)
    idf = weights.groupBy("token").agg((F.log(F.lit(1.0 + n) / (1.0 + F.max("df"))) + 1.0).alias("idf"))
    return work.write(points, "points"), kept, work.write(factors.join(idf, "token"), "tokens")


def run(tokens: DataFrame, key: str, config: Config = Config(), reduced: tuple[DataFrame, float, DataFrame] | None = None) -> tuple[DataFrame, dict]:
    """(key, label, probability, vector; metrics) of one configuration over long-form token counts. Fewer records than the smallest cluster, or
    than ten, are an error. reduced: what reduce_tokens gave for the same min_df, binary and components."""
    work = Workspace(tokens.sparkSession, "run")
    n = tokens.select(key).distinct().count()
    least = max(10, config.k if config.algorithm == "kmeans" else config.min_cluster_size)
    if n < least:
        raise ValueError(f"{n} records; a {config.algorithm} run takes {least} at least")
    points, kept, known = reduced or reduce_tokens(tokens, key, config)
    if config.algorithm == "kmeans":
        labels = kmeans(points, key, config.k, config.seeds).withColumn("probability", F.lit(None).cast("double"))
    else:
        labels = hdbscan(points, key, config.min_cluster_size, config.min_samples)
    done = work.write(points.join(labels, key), "labelled")
    sizes = {r["label"]: r["n"] for r in done.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    real = {k: v for k, v in sizes.items() if k != NOISE}
    rounded = lambda x: None if x is None else round(x, 4)
    metrics = {
        "algorithm": config.algorithm, "n_docs": n, "n_features": known.count(), "explained_variance": round(kept, 4), "n_clusters": len(real), "n_noise": sizes.get(NOISE, 0), "noise_share": round(sizes.get(NOISE, 0) / n, 4),
        "largest_share": round(max(real.values(), default=0) / n, 4), "silhouette": rounded(silhouette(done, key, config.sample, config.floor).first()[0]), "davies_bouldin": rounded(davies_bouldin(done).first()[0]) if len(real) > 1 else None,
    }
    return done, metrics


def model_of(done: DataFrame, known: DataFrame, binary: bool = True) -> Model:
    """The model of a run: done as run gives it, known (token, idf, factor) as reduce_tokens does."""
    c = centroids(done)
    farthest = done.where(F.col("label") != NOISE).join(c, "label").groupBy("label").agg(F.max(_to(F.col("vector").cast("array<double>"), F.col("centroid"))).alias("most"))
    return Model(known, c.join(farthest, "label"), binary)


def grid(algorithms: list[str], min_dfs: list[int], binaries: list[bool], components: list[int], ks: list[int], min_sizes: list[int], **fixed) -> list[Config]:
    """Every combination of the listed values that differ for the algorithm: k for k-means, the smallest cluster for density clustering."""
    return [
        Config(algorithm=a, min_df=df, binary=binary, components=d, **({"k": x} if a == "kmeans" else {"min_cluster_size": x}), **fixed)
        for df in min_dfs for binary in binaries for d in components for a in algorithms for x in (ks if a == "kmeans" else min_sizes)
    ]


def sweep(tokens: DataFrame, key: str, configs: list[Config]) -> DataFrame:
    """The metrics of each configuration, those with two clusters or more first, then by falling silhouette. Configurations with the same
    weights and components share one reduction."""
    shared: dict[tuple, tuple] = {}
    rows = []
    for c in configs:
        space = (c.min_df, c.binary, c.components)
        if space not in shared:
            shared[space] = reduce_tokens(tokens, key, c)
        rows.append(run(tokens, key, c, shared[space])[1] | {"k": c.k, "min_cluster_size": c.min_cluster_size, "min_df": c.min_df, "components": c.components, "binary": c.binary})
    rows.sort(key=lambda r: (r["n_clusters"] < 2, -(r["silhouette"] if r["silhouette"] is not None else -9.0)))
    return tokens.sparkSession.createDataFrame(pd.DataFrame([r | {"place": i} for i, r in enumerate(rows)]).astype({"silhouette": "float64", "davies_bouldin": "float64"}))


def by_size(clusters: DataFrame, label: str = "label", size: str = "size") -> DataFrame:
    """Clusters (one row each) in their order for reports: the largest first, noise last, equal ones by label."""
    return clusters.orderBy((F.col(label) == NOISE).asc_nulls_last(), F.col(size).desc(), label)


def assign(points: DataFrame, key: str, centres: DataFrame, most: float | None = None) -> DataFrame:
    """key, label, distance of new points to the nearest of the kept centres (label, centroid); NOISE beyond the distance `most`. The centres, one
    for each cluster, come to the driver and become part of the expression."""
    kept = [(r["label"], [float(x) for x in r["centroid"]]) for r in centres.orderBy("label").collect()]
    vector = F.col("vector").cast("array<double>")
    each = [F.struct(_to(vector, F.array(*map(F.lit, c))).alias("d"), F.lit(n).alias("label")) for n, c in kept]
    j = points.select(key, F.array_min(F.array(*each)).alias("b")).select(key, F.col("b.label").alias("label"), F.col("b.d").alias("distance"))
    return j if most is None else j.withColumn("label", F.when(F.col("distance") <= most, F.col("label")).otherwise(NOISE))


def template_names(labels: DataFrame) -> DataFrame:
    """labels with page_template_type: `unknown` for noise, else the cluster's number."""
    return labels.withColumn("page_template_type", F.when(F.col("label") == NOISE, "unknown").otherwise(F.concat(F.lit("dom_c"), F.col("label").cast("string"))))
