"""Queries on the merges, selections and reports. The state before a batch is what the tables held before the middle of their time span;
the batch is the rest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmesh.functions.timestamps import add_utc_micros, known_zones
from quillmesh.functions.urls import fallback_namespace
from quillmesh.operators import discovery, merge, reports, select
from quillmesh.plans.problems import read, with_zone

_CUT = "2026-01-01 00:00:00"


def _cut() -> Column:
    return F.lit(_CUT).cast("timestamp")


def _known(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = read(spark, sf_dir, "urls").where(F.col("discovered_at") < _cut()).select("url_id", "url", "confirmed", "namespace", "lastmod", "last_scraped", "discovered_at")
    return merge.last_in_batch(u, "url", ["discovered_at", "url_id"]).select("url", "confirmed", "namespace", "lastmod", "last_scraped")


def _batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "urls").where(F.col("discovered_at") >= _cut()).select("url_id", "url", "confirmed", "namespace", "lastmod", "last_scraped", "discovered_at")


def discovery_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = merge.merge_discovery(_known(spark, sf_dir), _batch(spark, sf_dir), ["discovered_at", "url_id"])
    return merged.withColumnRenamed("__outcome", "outcome")


def discovery_change_detect(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = merge.last_in_batch(_batch(spark, sf_dir), "url", ["discovered_at", "url_id"])
    return discovery.changed_entries(found, _known(spark, sf_dir))


def discovery_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = read(spark, sf_dir, "urls")
    return discovery.records(u.select("url", "confirmed", "lastmod").distinct(), F.coalesce(F.col("confirmed"), F.lit(False)), F.col("lastmod"))


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = read(spark, sf_dir, "fetch_log")
    return f.select("url", F.struct("seq", "fetch_id").alias("seq"), "ok", F.when(F.col("ok"), F.concat(F.lit("page "), F.col("fetch_id").cast("string"))).alias("payload"), "error", "error_kind", "attempts_used", F.col("logged_at").alias("at"))


def _stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "doms").where(F.col("received_at") < _cut())
    d = d.select("url", "dom_id", "received_at", "scrape_status", F.col("content_sha256").alias("payload"), F.col("attempts").cast("bigint").alias("attempts"), F.col("first_fetched_at").alias("first_at"))
    return merge.last_in_batch(d, "url", ["received_at", "dom_id"]).drop("dom_id", "received_at")


def fetch_result_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fetch log folded onto the pages stored before it."""
    return merge.fold_fetches(_log(spark, sf_dir), _stored(spark, sf_dir))


def fetch_tallies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.fetch_tallies(_log(spark, sf_dir), _stored(spark, sf_dir))


def _latest_doms(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "doms").select("url", "dom_id", "received_at", "scrape_status", F.col("first_fetched_at").alias("fetched"), F.col("attempts").cast("int").alias("attempts"), "last_error_kind", "content_sha256")
    return merge.last_in_batch(d, "url", ["received_at", "dom_id"])


def _latest_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = read(spark, sf_dir, "urls").select("url", "url_id", "discovered_at", "confirmed", "namespace", F.when(F.col("lastmod").rlike(r"^\d{4}-\d{2}-\d{2}$"), F.col("lastmod")).try_cast("timestamp").alias("lastmod"))
    return merge.last_in_batch(u, "url", ["discovered_at", "url_id"])


def scrape_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The urls to fetch, by bucket: never fetched, failed with attempts left, or out of date."""
    return select.first_pending(select.scrape_buckets(_latest_urls(spark, sf_dir).where("confirmed"), _latest_doms(spark, sf_dir), F.lit("2025-10-01 00:00:00").cast("timestamp")))


def scrape_pending_all_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """scrape_pending with lastmod in every form that is read (its SQL knows YYYY-MM-DD only) and the time of the last fetch in place of
    the first, which stands in where the last one can't be read."""
    zones = known_zones(spark)
    urls = merge.last_in_batch(read(spark, sf_dir, "urls").select("url", "url_id", "discovered_at", "confirmed", "lastmod"), "url", ["discovered_at", "url_id"])
    urls = add_utc_micros(urls, "us", F.col("lastmod"), F.lit("UTC"), zones).withColumn("lastmod", F.timestamp_micros("us"))
    doms = read(spark, sf_dir, "doms").select("url", "dom_id", "received_at", "scrape_status", "fetched_at", "worker_id", "first_fetched_at", F.col("attempts").cast("int").alias("attempts"), "last_error_kind")
    doms = with_zone(merge.last_in_batch(doms, "url", ["received_at", "dom_id"]), read(spark, sf_dir, "workers"))
    doms = add_utc_micros(doms, "us", F.col("fetched_at"), F.col("worker_zone"), zones).withColumn("fetched", F.coalesce(F.timestamp_micros("us"), "first_fetched_at"))
    return select.first_pending(select.scrape_buckets(urls.where("confirmed"), doms, F.lit("2025-10-01 00:00:00").cast("timestamp")))


def filter_unscraped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select.without_done(read(spark, sf_dir, "urls").select("url_id", "url"), read(spark, sf_dir, "doms"))


def parse_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages whose hash, parser and policy neither an entry nor a dead letter bears."""
    candidates = _latest_doms(spark, sf_dir).where("scrape_status = 'ok' and content_sha256 is not null").select("url", F.col("content_sha256").alias("sha"), F.lit("1.5.0").alias("parser_version"))
    entries = read(spark, sf_dir, "entries").select("url", F.lower("dom_content_sha256").alias("sha"), "parser_version")
    failures = read(spark, sf_dir, "doms").where("scrape_status = 'failed'").select("url", F.col("content_sha256").alias("sha"), F.lit("1.5.0").alias("parser_version"))
    return select.pending_versions(candidates, [entries, failures], ["url", "sha", "parser_version"]).select("url", "sha")


def feature_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    candidates = _latest_doms(spark, sf_dir).where("scrape_status = 'ok'").select("url", F.col("content_sha256"), F.lit(1).alias("extractor_version"))
    return select.pending_versions(candidates, [read(spark, sf_dir, "dom_features").select("url", "content_sha256", "extractor_version")], ["url", "content_sha256", "extractor_version"]).select("url")


def namespace_prefix_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select.in_namespaces(read(spark, sf_dir, "urls").select("url_id", "namespace"), select.namespace_names("'memes/events', sensitive,unknown"), check=True)


def failure_dead_letter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dead letters of failed pages: those before the middle, then the later ones merged in; urls with an entry are cleared."""
    d = read(spark, sf_dir, "doms").where("scrape_status = 'failed'").select("url", F.col("last_error").alias("error"), F.col("last_error_kind").alias("error_type"), "content_sha256", F.col("received_at").alias("failed_at"), "dom_id")
    old = merge.last_in_batch(d.where(F.col("failed_at") < _cut()), "url", ["failed_at", "dom_id"]).drop("dom_id").withColumn("attempts", F.lit(1))
    new = merge.last_in_batch(d.where(F.col("failed_at") >= _cut()), "url", ["failed_at", "dom_id"])
    return merge.dead_letters(old, new, read(spark, sf_dir, "entries").select("url"), F.lit("2026-09-01 00:00:00").cast("timestamp"))


def failure_namespace(spark: SparkSession, sf_dir: str) -> DataFrame:
    failed = read(spark, sf_dir, "doms").where("scrape_status = 'failed'").select("dom_id", "url")
    return select.with_namespace(failed, read(spark, sf_dir, "urls").select("url", "namespace"), fallback_namespace(F.col("url")))


def scrape_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "doms")
    return reports.counts(d, total=F.lit(True), ok=F.col("scrape_status") == "ok", failed=F.col("scrape_status") == "failed", permanent=F.col("last_error_kind") == "permanent", with_hash=F.col("content_sha256").isNotNull())


def index_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = read(spark, sf_dir, "urls")
    return u.groupBy(reports.label_or_unknown(F.col("namespace")).alias("namespace")).agg(F.count(F.lit(1)).alias("total"), F.count_if("confirmed").alias("confirmed"), F.count_if(F.col("lastmod").isNull()).alias("lastmod_null"))


def parse_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries by grade and by each field they lack."""
    e = read(spark, sf_dir, "entries")
    one = lambda what, c: c.groupBy(F.lit(what).alias("what"), F.col("name")).agg(F.count(F.lit(1)).alias("n"))
    return one("status", e.select(F.col("corpus_status").alias("name"))).unionByName(one("missing", e.select(F.explode("corpus_missing").alias("name")))).unionByName(one("parser", e.select(F.col("parser_version").alias("name"))))


def field_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "entries")
    full = lambda c: F.size(F.coalesce(F.col(c), F.array().cast("array<string>"))) > 0
    return reports.coverage(e, {"year": F.col("year").isNotNull(), "origin": F.col("origin") != "", "tags": full("tags"), "entry_type": full("entry_type"), "region": full("region"), "title": F.col("title") != ""})


def chunk_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select.chunks(read(spark, sf_dir, "urls").select("url_id"), 200, ["url_id"], 8)


def topk_remainder(spark: SparkSession, sf_dir: str) -> DataFrame:
    by_tag = read(spark, sf_dir, "entries").select("category", F.explode("tags").alias("tag")).where("tag is not null").groupBy("category", "tag").agg(F.count(F.lit(1)).alias("n"))
    return reports.top_with_rest(by_tag, ["category"], "tag", "n", 30)


def run_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = read(spark, sf_dir, "run_summaries").where("stage = 'parse'").select("run_id", "state", "created_at").distinct()
    return reports.last_n(r, ["created_at", "run_id", "state"], 20)


def run_summary_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each run: the state it reported last, the time it was first seen."""
    r = read(spark, sf_dir, "run_summaries").withColumn("key", F.concat_ws(":", "stage", "run_id"))
    r = r.select("key", "state", "created_at", F.col("created_at").alias("updated_at"))
    first, rest = r.where(F.col("created_at") < _cut()), r.where(F.col("created_at") >= _cut())
    old = merge.keyed_merge(merge.last_in_batch(first, "key", ["updated_at", "state"]).limit(0), merge.last_in_batch(first, "key", ["updated_at", "state"]), "key", {"created_at": merge.keep_old}).drop("__outcome")
    return merge.keyed_merge(old, merge.last_in_batch(rest, "key", ["updated_at", "state"]), "key", {"created_at": merge.keep_old}).drop("__outcome")


def summary_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The numbers of each parse run's summary."""
    r = read(spark, sf_dir, "run_summaries").where("summary is not null").select("run_id", "summary").distinct()
    return reports.flatten(r, "run_id", "summary").select("run_id", "path", "value").distinct()


def stage_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = read(spark, sf_dir, "run_summaries").where("summary is not null").select("stage", F.from_json("summary", "map<string,string>").alias("m"))
    return r.select("stage", F.explode("m").alias("key", "value")).groupBy("stage", "key").agg(F.sum(F.col("value").try_cast("bigint")).alias("total")).where("total is not null")


def trend_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = read(spark, sf_dir, "run_summaries").where("summary is not null and state = 'success'").select(F.concat_ws("@", "stage", F.date_format("created_at", "yyyy-MM-dd HH:mm:ss")).alias("k"), "stage", F.col("created_at"), "summary")
    flat = reports.flatten(r.select("k", "summary").distinct(), "k", "summary").where("trend").select("k", "path", "value").distinct()
    points = flat.select(F.concat_ws(".", F.substring_index("k", "@", 1), "path").alias("path"), F.substring_index("k", "@", -1).cast("timestamp").alias("at"), "value")
    return reports.trend_series(points.groupBy("path", "at").agg(F.max("value").alias("value")), 3)


def taxonomy_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return discovery.prefixes(read(spark, sf_dir, "urls").select("url").distinct())


def sitemap_reach(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The regions, nations and customers that can be reached from the regions, level by level, as a tree of sitemaps."""
    n, c = read(spark, sf_dir, "nation"), read(spark, sf_dir, "customer")
    name = lambda kind, col: F.concat(F.lit(kind), F.col(col).cast("string"))
    children = n.select(name("r", "n_regionkey").alias("parent"), name("n", "n_nationkey").alias("child")).unionByName(c.select(name("n", "c_nationkey").alias("parent"), name("c", "c_custkey").alias("child")))
    return discovery.sitemap_tree(read(spark, sf_dir, "region").select(name("r", "r_regionkey").alias("loc")), children)


def table_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All urls as an export, by namespace and url."""
    u = read(spark, sf_dir, "urls").where("url is not null and url_id is not null")
    u = u.select(F.coalesce("namespace", F.lit("unknown")).alias("namespace"), "url", "url_id", F.coalesce("confirmed", F.lit(False)).alias("confirmed"))
    return reports.snapshot(u, ["namespace", "url", "url_id"])


_FUNCTIONS = (
    discovery_merge, discovery_change_detect, discovery_records, fetch_result_merge, fetch_tallies, scrape_pending, scrape_pending_all_forms, filter_unscraped, parse_pending, feature_pending, namespace_prefix_filter, failure_dead_letter, failure_namespace, scrape_stats, index_summary, parse_stats, field_coverage,
    chunk_assign, topk_remainder, run_history, run_summary_merge, summary_flatten, stage_totals, trend_series, taxonomy_prefixes, sitemap_reach, table_snapshot,
)
QUERIES = {f.__name__: f for f in _FUNCTIONS}

_T = f"timestamptz '{_CUT}+00'"
_KNOWN = f"known as (select url, confirmed, namespace, lastmod, last_scraped from urls where discovered_at < {_T} and url is not null qualify row_number() over (partition by url order by discovered_at desc, url_id desc) = 1)"
_LAST = f"batch as (select url, confirmed, namespace, lastmod, last_scraped from urls where discovered_at >= {_T} and url is not null qualify row_number() over (partition by url order by discovered_at desc, url_id desc) = 1)"
_STORED = f"stored as (select url, scrape_status, content_sha256 as payload, attempts, first_fetched_at as first_at from doms where received_at < {_T} and url is not null qualify row_number() over (partition by url order by received_at desc, dom_id desc) = 1)"
_DOMS = "d as (select * exclude html, first_fetched_at as fetched from doms where url is not null qualify row_number() over (partition by url order by received_at desc, dom_id desc) = 1)"
_PATH = r"regexp_extract(url, '^[A-Za-z]+://[^/?#]*([^?#]*)', 1)"
_SEGS = f"list_filter(string_split({_PATH}, '/'), lambda s: s <> '')"


def _prefix_case(names: list[str], text: str, default: str) -> str:
    return "CASE " + " ".join(f"WHEN starts_with({text}, '/{n}/') THEN '{n}'" for n in names) + f" ELSE {default} END"


def _oracles() -> dict[str, str]:
    from quillmesh.site import FALLBACK_NAMESPACES, NAMESPACES

    return {
        "discovery_merge": f"""with {_KNOWN}, {_LAST}, j as (select coalesce(k.url, b.url) as url, coalesce(k.confirmed, false) or coalesce(b.confirmed, false) as confirmed, coalesce(b.namespace, k.namespace) as namespace, coalesce(b.lastmod, k.lastmod) as lm, coalesce(k.last_scraped, b.last_scraped) as last_scraped, case when b.url is null then 'kept' when k.url is null then 'added' else 'updated' end as outcome from known k full join batch b on k.url = b.url)
select url, confirmed, namespace, case when confirmed then lm end as lastmod, last_scraped, outcome from j""",
        "discovery_change_detect": f"with {_KNOWN}, {_LAST} select b.url, b.lastmod, case when b.lastmod is not null then true else coalesce(k.confirmed, false) end as confirmed, case when k.url is null then 'added' else 'updated' end as change from batch b left join known k using (url) where k.url is null or b.lastmod is distinct from k.lastmod",
        "discovery_records": f"select url, {_prefix_case(NAMESPACES, f'regexp_replace({_PATH}, ' + repr('/+$') + ', ' + repr('') + ')', 'null')} as namespace, coalesce(confirmed, false) as confirmed, case when coalesce(confirmed, false) then lastmod end as lastmod from (select distinct url, confirmed, lastmod from urls)",
        "fetch_result_merge": f"""with {_STORED}, f as (select *, row_number() over (partition by url order by seq desc, fetch_id desc, logged_at desc) as r from fetch_log where url is not null),
g as (select url, count_if(ok) as ok, count_if(not ok) as bad, sum(attempts_used) as used, min(case when ok then logged_at end) as first_good, arg_max(case when ok then 'page ' || fetch_id end, case when ok then (seq, fetch_id) end) as p from f group by url),
l as (select url, case when not ok then error end as last_error, case when not ok then error_kind end as last_error_kind from f where r = 1)
select g.url, case when g.ok > 0 or (s.scrape_status = 'ok' and s.payload is not null) then 'ok' else 'failed' end as scrape_status, coalesce(g.p, s.payload) as payload, coalesce(s.attempts, 0) + g.used as attempts, coalesce(s.first_at, g.first_good) as first_at, last_error, last_error_kind, g.ok, g.bad, coalesce(s.scrape_status = 'ok' and s.payload is not null, false) as was_ok from g join l using (url) left join stored s using (url)""",
        "fetch_tallies": f"""with {_STORED}, f as (select f.*, min(case when ok then (seq, fetch_id) end) over (partition by url) as fg from fetch_log f where url is not null)
select case when ok then 'ok' when s.url is not null or fg < (seq, fetch_id) then 'kept_ok' else 'failed' end as outcome, count(*) as n from f left join (select url from stored where scrape_status = 'ok' and payload is not null) s using (url) group by all""",
        "scrape_pending": f"""with {_DOMS}, u as (select url, case when regexp_matches(lastmod, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$') then try_cast(lastmod || ' 00:00:00+00' as timestamptz) end as lastmod, confirmed from urls where url is not null qualify row_number() over (partition by url order by discovered_at desc, url_id desc) = 1),
b as (select u.url, case when d.scrape_status is null then 0 when d.scrape_status = 'failed' and coalesce(attempts, 0) < 3 and coalesce(last_error_kind <> 'permanent', true) then 1 when d.scrape_status = 'ok' and (fetched is null or coalesce(u.lastmod > fetched, false) or fetched < timestamptz '2025-10-01 00:00:00+00') then 2 end as bucket from u left join d using (url) where confirmed)
select url, bucket from b where bucket is not null""",
        "filter_unscraped": "select url_id, url from urls where url is null or url not in (select url from doms where scrape_status = 'ok' and url is not null)",
        "parse_pending": f"with {_DOMS} select url, content_sha256 as sha from d where scrape_status = 'ok' and content_sha256 is not null and not exists (select 1 from entries e where e.url = d.url and lower(e.dom_content_sha256) = d.content_sha256 and e.parser_version = '1.5.0') and not exists (select 1 from doms f where f.scrape_status = 'failed' and f.url = d.url and f.content_sha256 = d.content_sha256)",
        "feature_pending": f"with {_DOMS} select url from d where scrape_status = 'ok' and not exists (select 1 from dom_features f where f.url = d.url and f.content_sha256 is not distinct from d.content_sha256 and f.extractor_version = 1)",
        "namespace_prefix_filter": "select url_id, namespace from urls where namespace = 'memes/events' or starts_with(namespace, 'memes/events/') or namespace = 'sensitive' or starts_with(namespace, 'sensitive/') or namespace is null",
        "failure_dead_letter": f"""with f as (select url, last_error as error, last_error_kind as error_type, content_sha256, received_at as failed_at, dom_id from doms where scrape_status = 'failed' and url is not null),
o as (select * from f where failed_at < {_T} qualify row_number() over (partition by url order by failed_at desc, dom_id desc) = 1), n as (select * from f where failed_at >= {_T} qualify row_number() over (partition by url order by failed_at desc, dom_id desc) = 1)
select coalesce(n.url, o.url) as url, case when n.url is not null then left(n.error, 2000) else o.error end as error, case when n.url is not null then n.error_type else o.error_type end as error_type, case when n.url is not null then n.content_sha256 else o.content_sha256 end as content_sha256, case when n.url is not null then timestamptz '2026-09-01 00:00:00+00' else o.failed_at end as failed_at, (n.url is not null)::int + (o.url is not null)::int as attempts from o full join n on o.url = n.url where coalesce(n.url, o.url) not in (select url from entries where url is not null)""",
        "failure_namespace": f"with n as (select url, max(namespace) as ns from urls where url is not null group by url) select dom_id, url, coalesce(nullif(ns, ''), {_prefix_case(FALLBACK_NAMESPACES, _PATH, chr(39) + 'unknown' + chr(39))}) as namespace from doms left join n using (url) where scrape_status = 'failed'",
        "scrape_stats": "select count(*) as total, count_if(scrape_status = 'ok') as ok, count_if(scrape_status = 'failed') as failed, count_if(last_error_kind = 'permanent') as permanent, count_if(content_sha256 is not null) as with_hash from doms",
        "index_summary": "select coalesce(nullif(namespace, ''), 'unknown') as namespace, count(*) as total, count_if(confirmed) as confirmed, count_if(lastmod is null) as lastmod_null from urls group by 1",
        "parse_stats": "select 'status' as what, corpus_status as name, count(*) as n from entries group by all union all select 'missing', x, count(*) from (select unnest(corpus_missing) as x from entries) group by all union all select 'parser', parser_version, count(*) from entries group by all",
        "field_coverage": "with c as (select count(*) as n, count_if(year is not null) as year, count_if(origin <> '') as origin, count_if(len(tags) > 0) as tags, count_if(len(entry_type) > 0) as entry_type, count_if(len(region) > 0) as region, count_if(title <> '') as title from entries), l as (unpivot c on year, origin, tags, entry_type, region, title into name field value hits) select field, hits, round_even(hits / n, 4) as share from l",
        "chunk_assign": "select url_id, (row_number() over (order by url_id) - 1) // 200 as chunk from urls",
        "topk_remainder": """with t as (select category, tag, count(*) as n from (select category, unnest(tags) as tag from entries) where tag is not null group by all), r as (select *, row_number() over (partition by category order by n desc, tag) as rank from t)
select category, tag, n, rank from r where rank <= 30 union all select category, '(+' || count(*) || ' more)', sum(n), 31 from r where rank > 30 group by category""",
        "run_history": "select * from (select distinct run_id, state, created_at from run_summaries where stage = 'parse') order by created_at desc, run_id desc, state desc limit 20",
        "run_summary_merge": f"""with r as (select stage || ':' || run_id as key, state, created_at from run_summaries where run_id is not null), f as (select * from r where created_at < {_T} qualify row_number() over (partition by key order by created_at desc, state desc) = 1), l as (select * from r where created_at >= {_T} qualify row_number() over (partition by key order by created_at desc, state desc) = 1)
select coalesce(l.key, f.key) as key, coalesce(l.state, f.state) as state, coalesce(f.created_at, l.created_at) as created_at, coalesce(l.created_at, f.created_at) as updated_at from f full join l on f.key = l.key""",
        "summary_flatten": "with k as (select distinct run_id, summary, unnest(json_keys(summary)) as path from run_summaries where summary is not null) select distinct run_id, path, cast(json_extract(summary, '$.' || path) as double) as value from k where json_type(json_extract(summary, '$.' || path)) in ('UBIGINT', 'BIGINT', 'DOUBLE')",
        "stage_totals": "with k as (select stage, summary, unnest(json_keys(summary)) as key from run_summaries where summary is not null) select stage, key, sum(cast(json_extract(summary, '$.' || key) as bigint)) as total from k where json_type(json_extract(summary, '$.' || key)) in ('UBIGINT', 'BIGINT') group by all",
        "trend_series": """with k as (select distinct stage, date_trunc('second', created_at) as "at", summary, unnest(json_keys(summary)) as path from run_summaries where summary is not null and state = 'success'),
p as (select stage as grp, stage || '.' || path as path, "at", max(cast(json_extract(summary, '$.' || path) as double)) as value from k where json_type(json_extract(summary, '$.' || path)) in ('UBIGINT', 'BIGINT', 'DOUBLE') group by all),
s as (select grp, path, row_number() over (partition by grp order by arg_max(value, "at") desc, path) as r from p group by grp, path), o as (select p.* from p join s using (grp, path) where r <= 3),
g as (select grp, coalesce(max(case when value > 0 then value end) / min(case when value > 0 then value end) > 1000, false) as log_scale from o group by grp)
select grp, path, "at", value, log_scale from o join g using (grp)""",
        "taxonomy_prefixes": f"with s as (select {_SEGS} as g from (select distinct url from urls)), p as (select array_to_string(g[:len(g) - 1], '/') as label from s where len(g) >= 2) select '/' || label || '/' as prefix, label, count(*) as n from p group by all having count(*) >= 2",
        "sitemap_reach": "with recursive e as (select 'r' || n_regionkey as parent, 'n' || n_nationkey as child from nation union all select 'n' || c_nationkey, 'c' || c_custkey from customer), t as (select 'r' || r_regionkey as loc from region union select child from t join e on parent = loc) select loc from t",
        "table_snapshot": """with u as (select coalesce(namespace, 'unknown') as namespace, url, url_id, coalesce(confirmed, false) as confirmed from urls where url is not null and url_id is not null)
select -1 as place, json_object('total', count(*))::varchar as json from u union all select row_number() over (order by namespace, url, url_id) - 1, json_object('namespace', namespace, 'url', url, 'url_id', url_id, 'confirmed', confirmed)::varchar from u""",
    }


ORACLES = _oracles()
