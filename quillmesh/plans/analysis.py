"""Queries on features, clusters, triples, streams and the star schema."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmesh.operators import clustering, features, merge, rdf
from quillmesh.operators.select import numbered
from quillmesh.plans.problems import read
from quillmesh.session import shared_folder
from quillmesh.streaming import stages


def token_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.document_frequency(features.word_counts(read(spark, sf_dir, "documents"), "doc_id", "text"), 2)


def token_tfidf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sublinear weights of the words of each document."""
    w = features.tfidf(features.word_counts(read(spark, sf_dir, "documents"), "doc_id", "text"), "doc_id", 2, binary=False)
    return w.select("doc_id", "token", F.round("weight", 6).alias("weight"))


def structure_tfidf(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = features.tfidf(features.token_counts(read(spark, sf_dir, "dom_features"), "feature_id"), "feature_id")
    return w.select("feature_id", "token", F.round("weight", 6).alias("weight"))


def top_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words that distinguish the documents of each language."""
    d = read(spark, sf_dir, "documents")
    w = features.tfidf(features.word_counts(d, "doc_id", "text"), "doc_id", 2)
    return features.top_tokens(w, d.select("doc_id", F.coalesce("lang", F.lit("none")).alias("label")), "doc_id")


def _points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("vector"), "label")


def kmeans_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = read(spark, sf_dir, "embeddings").select("label").distinct().count()
    return clustering.kmeans(_points(spark, sf_dir).drop("label"), "vec_id", k, seeds=3)


def hdbscan_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.hdbscan(_points(spark, sf_dir).drop("label"), "vec_id", min_cluster_size=10, min_samples=5)


def davies_bouldin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.davies_bouldin(_points(spark, sf_dir)).select(F.round("davies_bouldin", 6).alias("davies_bouldin"))


def stratified_silhouette(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.silhouette(_points(spark, sf_dir), "vec_id", 200, 20, F.col("vec_id")).select(F.round("silhouette", 6).alias("silhouette"))


def stratified_silhouette_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The silhouette of the operator's own hashed sample (4,000, at least 50 of a label); stratified_silhouette takes the 200 that its SQL
    can pair."""
    return clustering.silhouette(_points(spark, sf_dir), "vec_id").select(F.round("silhouette", 6).alias("silhouette"))


def cluster_medoid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.medoids(_points(spark, sf_dir), "vec_id")


def cluster_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.samples(_points(spark, sf_dir), "vec_id").select("label", F.size("samples").alias("n"))


def template_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Templates by k-means over the reduced structure tokens of all pages."""
    tokens = features.token_counts(read(spark, sf_dir, "dom_features"), "feature_id")
    done, _ = clustering.run(tokens, "feature_id", clustering.Config(algorithm="kmeans", k=8, components=10, seeds=2, sample=1000))
    return clustering.template_names(done.select("feature_id", "label"))


def cluster_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = features.token_counts(read(spark, sf_dir, "dom_features"), "feature_id")
    configs = [clustering.Config(algorithm="kmeans", k=k, components=8, seeds=1, sample=500) for k in (4, 8)]
    return clustering.sweep(tokens, "feature_id", configs).select("place", "k", "n_clusters", "n_docs", "n_features", "silhouette", "davies_bouldin")


def _blobs(spark: SparkSession, sf_dir: str, groups: int = 6) -> DataFrame:
    """The customers as points around one corner of a cube for each group."""
    c = read(spark, sf_dir, "customer").where("c_custkey is not null")
    near = lambda d: F.pmod(F.xxhash64(F.lit(d), "c_custkey"), F.lit(1000)) / 5000.0
    corner = [F.when(F.pmod(F.shiftright(F.col("c_custkey") % groups + 1, d), F.lit(2)) == 1, 10.0).otherwise(0.0) + near(d) for d in range(3)]
    return c.select("c_custkey", F.array(*corner).alias("vector"))


def _rooted(labels: DataFrame, key: str) -> DataFrame:
    """Labels by the smallest key of each cluster, whatever their numbers."""
    return labels.join(labels.groupBy("label").agg(F.min(key).alias("root")), "label").select(key, "root")


def kmeans_blobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points around six corners fall into the six groups they were made from."""
    return _rooted(clustering.kmeans(_blobs(spark, sf_dir), "c_custkey", 6), "c_custkey")


def hdbscan_blobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by density."""
    return _rooted(clustering.hdbscan(_blobs(spark, sf_dir), "c_custkey", min_cluster_size=10), "c_custkey")


def _party_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read(spark, sf_dir, "supplier").where("s_suppkey is not null")
    words = F.array(*(F.concat(F.lit(n), (F.col(c) % m).cast("string")) for n, c, m in (("a", "s_nationkey", 5), ("b", "s_nationkey", 5), ("c", "s_suppkey", 3))))
    return s.select("s_suppkey", F.explode(words).alias("token"), F.lit(1).alias("count")).where("token is not null")


def svd_cosines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reduced to as many components as the weights have, records keep their cosines; here those of neighbours."""
    points, *_ = clustering.svd(features.tfidf(_party_tokens(spark, sf_dir), "s_suppkey"), "s_suppkey", 12)
    other = points.select((F.col("s_suppkey") - 1).alias("s_suppkey"), F.col("vector").alias("w"))
    dot = F.aggregate(F.zip_with("vector", "w", lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)
    return points.join(other, "s_suppkey").select("s_suppkey", F.round(dot, 5).alias("cosine"))


def model_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of a run, given to the kept model as new ones, go to the cluster they are in."""
    tokens = _party_tokens(spark, sf_dir)
    config = clustering.Config(algorithm="kmeans", k=5, components=8)
    reduced = clustering.reduce_tokens(tokens, "s_suppkey", config)
    done, _ = clustering.run(tokens, "s_suppkey", config, reduced)
    path = f"{shared_folder(spark)}/model-{uuid.uuid4().hex[:12]}"
    clustering.model_of(done, reduced[2]).save(path)
    found = clustering.Model.load(spark, path).assign(tokens, "s_suppkey")
    return found.join(done.select("s_suppkey", F.col("label").alias("own")), "s_suppkey").select("s_suppkey", (F.col("label") == F.col("own")).alias("same"))


def cluster_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clusters of each run in the order of reports."""
    f = read(spark, sf_dir, "dom_features").where("cluster_id is not null and cluster_run_id is not null")
    sizes = f.groupBy("cluster_run_id", F.col("cluster_id").alias("label")).agg(F.count(F.lit(1)).alias("size"))
    out = None
    for run in [r[0] for r in sizes.select("cluster_run_id").distinct().orderBy("cluster_run_id").collect()]:  # a row for each run
        one = numbered(clustering.by_size(sizes.where(F.col("cluster_run_id") == run)).withColumn("__noise", F.col("label") == clustering.NOISE).withColumn("__less", -F.col("size")), ["__noise", "__less", "label"], "place").drop("__noise", "__less")
        out = one if out is None else out.unionByName(one)
    return sizes.withColumn("place", F.lit(0).cast("bigint")).limit(0) if out is None else out


def cluster_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features by extractor version and cluster run, with the namespaces of their pages' urls."""
    f = read(spark, sf_dir, "dom_features")
    return f.groupBy("extractor_version", "cluster_run_id").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("cluster_id") == clustering.NOISE).alias("noise"), F.count_distinct("cluster_id").alias("clusters"))


def cluster_namespaces(spark: SparkSession, sf_dir: str) -> DataFrame:
    f, u = read(spark, sf_dir, "dom_features"), read(spark, sf_dir, "urls")
    names = u.where("url is not null").groupBy("url").agg(F.max("namespace").alias("namespace"))
    return f.where("cluster_id is not null").join(names, "url", "left").groupBy("cluster_run_id", "cluster_id", F.coalesce("namespace", F.lit("unknown")).alias("namespace")).agg(F.count(F.lit(1)).alias("n"))


def _triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The star schema's customers and suppliers as triples."""
    c, s = read(spark, sf_dir, "customer"), read(spark, sf_dir, "supplier")
    t = lambda df, key, p, o: df.select(F.concat(F.lit(key[0]), F.col(key).cast("string")).alias("s"), F.lit(p).alias("p"), o.cast("string").alias("o"))
    parts = [t(c, "c_custkey", "is", F.lit("customer")), t(c, "c_custkey", "nation", F.col("c_nationkey")), t(c.where("c_acctbal < 0"), "c_custkey", "debt", F.col("c_acctbal")), t(s, "s_suppkey", "is", F.lit("supplier")), t(s, "s_suppkey", "nation", F.col("s_nationkey")), t(read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey"), "c_custkey", "order", F.col("o_orderkey"))]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def rdf_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rdf.shape(_triples(spark, sf_dir), 0.05).select("p", F.round("share", 6).alias("share"), "least", "most", "everywhere")


def rdf_optional(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _triples(spark, sf_dir)
    return rdf.with_optional(rdf.instances(t, "is", "customer"), rdf.about(t, rdf.instances(t, "is", "customer"), "d").unionByName(t.where("p = 'nation'")), nation="nation", debt="debt")


def rdf_shex(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rdf.shex(rdf.shape(_triples(spark, sf_dir), 0.05), "Party")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{sf_dir}/events.parquet"
    s = spark.readStream.schema(spark.read.parquet(path).schema).format("parquet")
    # A file stream reads a folder; a single file is named by a pattern that fits it alone.
    return s.load(f"{sf_dir}/event[s].parquet").withColumn("ts", F.col("ts").cast("timestamp"))


def stream_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state of each user after the stream: the latest event, the events counted."""
    place = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex[:12]}"
    stream = _events(spark, sf_dir).select("user_id", F.struct("ts", "event_id").alias("at"), "event_type", "value")
    table = merge.VersionedTable(spark, f"{place}/users")
    stages.merge_stream(stream, table, "user_id", {"at": merge.latest_of}, ["at"], f"{place}/checkpoint").awaitTermination()
    return table.read().select("user_id", F.col("at.event_id").alias("event_id"), "event_type", "value")


def stream_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events by hour and type, counted in a stream with a watermark; windows that are final."""
    place = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex[:12]}"
    counts = stages.windowed_counts(_events(spark, sf_dir), "ts", "1 day", "10 minutes", "event_type")
    counts.writeStream.format("parquet").outputMode("append").option("path", f"{place}/out").option("checkpointLocation", f"{place}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema("start timestamp, end timestamp, event_type string, n bigint").parquet(f"{place}/out")


def star_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revenue by region and year of order."""
    l, o, c, n, r = (read(spark, sf_dir, t) for t in ("lineitem", "orders", "customer", "nation", "region"))
    j = l.join(o, l.l_orderkey == o.o_orderkey).join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    return j.groupBy("r_name", F.year("o_orderdate").alias("year")).agg(F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"), F.count(F.lit(1)).alias("n"))


_FUNCTIONS = (
    token_df, token_tfidf, structure_tfidf, top_tokens, kmeans_embeddings, hdbscan_embeddings, davies_bouldin, stratified_silhouette, stratified_silhouette_default, cluster_medoid, cluster_samples, kmeans_blobs, hdbscan_blobs, svd_cosines, model_assign, cluster_order, template_clusters, cluster_sweep, cluster_stats, cluster_namespaces, rdf_shape, rdf_optional, rdf_shex, stream_merge, stream_windows, star_revenue,
)
QUERIES = {f.__name__: f for f in _FUNCTIONS}

_WORDS = "w as (select doc_id, token, count(*) as c from (select doc_id, unnest(regexp_split_to_array(lower(text), '[^a-z0-9]+')) as token from documents where doc_id is not null) where token <> '' group by all), n as (select count(distinct doc_id)::double as n from w), d as (select token, count(*) as df from w group by token having count(*) >= 2)"
_DIM = "e as (select vec_id, label, unnest(embedding)::double as x, unnest(range(1, len(embedding) + 1)) as d from embeddings where label <> -1), c as (select label, d, avg(x) as m from e group by all)"
_DIST = f"{_DIM}, t as (select e.vec_id, e.label, sqrt(sum((e.x - c.m) ** 2)) as r from e join c using (label, d) group by all)"
_TRIPLES = "t as (select 'c' || c_custkey as s, 'is' as p, 'customer' as o from customer union all select 'c' || c_custkey, 'nation', c_nationkey::varchar from customer union all select 'c' || c_custkey, 'debt', 'x' from customer where c_acctbal < 0 union all select 's' || s_suppkey, 'is', 'supplier' from supplier union all select 's' || s_suppkey, 'nation', s_nationkey::varchar from supplier union all select 'c' || o_custkey, 'order', o_orderkey::varchar from orders)"
_GROUP = "g as (select c_custkey, c_custkey % 6 as g from customer where c_custkey is not null), h as (select g, min(c_custkey) as root from g group by g) select c_custkey, root from g join h using (g)"
_PARTY = "p as (select s_suppkey, unnest(['a' || s_nationkey % 5, 'b' || s_nationkey % 5, 'c' || s_suppkey % 3]) as token from supplier where s_suppkey is not null), q as (select * from p where token is not null), n as (select count(distinct s_suppkey)::double as n from q), d as (select token, count(*) as df from q group by token having count(*) >= 2), r as (select s_suppkey, token, ln((1 + n) / (1 + df)) + 1 as v from q join d using (token), n), w as (select s_suppkey, token, v / sqrt(sum(v * v) over (partition by s_suppkey)) as w from r)"
ORACLES = {
    "kmeans_blobs": f"with {_GROUP}",
    "hdbscan_blobs": f"with {_GROUP}",
    "svd_cosines": f"with {_PARTY}, k as (select distinct s_suppkey from w) select k.s_suppkey, round(coalesce((select sum(a.w * b.w) from w a join w b on a.token = b.token where a.s_suppkey = k.s_suppkey and b.s_suppkey = k.s_suppkey + 1), 0), 5) as cosine from k where s_suppkey + 1 in (select s_suppkey from k)",
    "model_assign": f"with {_PARTY} select distinct s_suppkey, true as same from w",
    "cluster_order": "with s as (select cluster_run_id, cluster_id as label, count(*) as size from dom_features where cluster_id is not null and cluster_run_id is not null group by all) select *, row_number() over (partition by cluster_run_id order by label = -1, size desc, label) - 1 as place from s",
    "rdf_shex": f"with {_TRIPLES}, k as (select s, p, count(*) as c from t group by all), g as (select p, count(*) / (select count(distinct s) from t)::double as share, min(c) as least, max(c) as most from k group by p), l as (select '  <' || p || '> . ' || case when most = 1 then case when share = 1.0 then '' else '?' end else case when share = 1.0 then '+' else '*' end end || ' ;' as line, p from g where share >= 0.05) select '<Party> {{' || chr(10) || string_agg(line, chr(10) order by p) || chr(10) || '}}' as text from l",
    "token_df": f"with {_WORDS} select token, df from d",
    "token_tfidf": f"with {_WORDS}, r as (select doc_id, token, (1 + ln(c)) * (ln((1 + n) / (1 + df)) + 1) as v from w join d using (token), n) select doc_id, token, round(v / sqrt(sum(v * v) over (partition by doc_id)), 6) as weight from r",
    "structure_tfidf": "with o as (select feature_id, unnest(map_entries(tokens)) as e from dom_features where feature_id is not null), w as (select feature_id, e.key as token from o where e.value > 0), n as (select count(distinct feature_id)::double as n from w), d as (select token, count(*) as df from w group by token having count(*) >= 2), r as (select feature_id, token, ln((1 + n) / (1 + df)) + 1 as v from w join d using (token), n) select feature_id, token, round(v / sqrt(sum(v * v) over (partition by feature_id)), 6) as weight from r",
    "top_tokens": f"""with {_WORDS}, r as (select doc_id, token, ln((1 + n) / (1 + df)) + 1 as v from w join d using (token), n), x as (select doc_id, token, v / sqrt(sum(v * v) over (partition by doc_id)) as weight from r), l as (select doc_id, coalesce(lang, 'none') as label from documents), z as (select label, count(*) as size from l group by label),
i as (select label, token, sum(weight) as s from x join l using (doc_id) group by all), m as (select token, sum(s) / (select count(*) from l) as mean from i group by token), k as (select label, token, round(s / size - mean, 5) as contrast from i join z using (label) join m using (token)), q as (select *, row_number() over (partition by label order by contrast desc, token) as rank from k where contrast > 0) select label, token, contrast, rank from q where rank <= 12""",
    "davies_bouldin": f"with {_DIST}, s as (select label, avg(r) as s from t group by label), p as (select a.label as i, b.label as j, sqrt(sum((a.m - b.m) ** 2)) as m from c a join c b on a.d = b.d and a.label <> b.label group by all), w as (select i, max((x.s + y.s) / m) as r from p join s x on x.label = i join s y on y.label = j group by i) select round(avg(r), 6) as davies_bouldin from w",
    "stratified_silhouette": """with l as (select vec_id, label, embedding, count(*) over (partition by label) as size, count(*) over () as n, row_number() over (partition by label order by vec_id) as r from embeddings where label <> -1), p as (select * from l where r <= least(size, greatest(20, round_even(200.0 * size / n, 0)))),
e as (select vec_id, label, unnest(embedding)::double as x, unnest(range(1, len(embedding) + 1)) as d from p), q as (select a.vec_id, a.label as own, b.label as other, b.vec_id as w, sqrt(sum((a.x - b.x) ** 2)) as r from e a join e b on a.d = b.d and a.vec_id <> b.vec_id group by all),
m as (select vec_id, own, other, avg(r) as r from q group by all), s as (select vec_id, max(case when own = other then r end) as a, min(case when own <> other then r end) as b from m group by vec_id) select round(avg(coalesce((b - a) / greatest(a, b), 0)), 6) as silhouette from s""",
    "cluster_medoid": f"with {_DIST}, k as (select label, vec_id, row_number() over (partition by label order by round(r, 9), vec_id) as o, count(*) over (partition by label) as size from t) select label, vec_id as medoid, size from k where o = 1",
    "cluster_samples": "select label, least(5, count(*)) as n from embeddings group by label",
    "cluster_stats": "select extractor_version, cluster_run_id, count(*) as n, count(*) filter (where cluster_id = -1) as noise, count(distinct cluster_id) as clusters from dom_features group by all",
    "cluster_namespaces": "with u as (select url, max(namespace) as namespace from urls where url is not null group by url) select cluster_run_id, cluster_id, coalesce(namespace, 'unknown') as namespace, count(*) as n from dom_features left join u using (url) where cluster_id is not null group by all",
    "rdf_shape": f"with {_TRIPLES}, k as (select s, p, count(*) as c from t group by all), g as (select p, count(*) / (select count(distinct s) from t)::double as share, min(c) as least, max(c) as most from k group by p) select p, round(share, 6) as share, least, most, share = 1.0 as everywhere from g where share >= 0.05",
    "rdf_optional": "select 'c' || c_custkey as s, c_nationkey::varchar as nation, case when c_acctbal < 0 then c_acctbal::varchar end as debt from customer",
    "stream_merge": "select user_id, event_id, event_type, value from events where user_id is not null qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1",
    "stream_windows": "with w as (select time_bucket(interval '1 day', ts) as start, event_type, count(*) as n from events group by all), m as (select max(ts) - interval '10 minutes' as mark from events) select start at time zone 'UTC' as start, (start + interval '1 day') at time zone 'UTC' as end, event_type, n from w, m where start + interval '1 day' <= mark",
    "star_revenue": "select r_name, year(o_orderdate) as year, round(sum(l_extendedprice * (1 - l_discount)), 2) as revenue, count(*) as n from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey group by all",
}
