"""The whole corpus in one folder of versioned tables, and its stages: discover, scrape, parse, describe, cluster, report.

Each stage selects only what is new or stale, works, merges its result and writes its summary. A stage that fails leaves the tables as they
were, so it can simply be run again.
"""

from __future__ import annotations

import json
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmesh.functions.timestamps import add_utc_micros, known_zones
from quillmesh.functions.urls import fallback_namespace, namespace
from quillmesh.operators import clustering, discovery, features, merge, pages, reports, select
from quillmesh.session import Workspace
from quillmesh.site import DEFAULT_SITE, SiteProfile
from quillmesh.sources import readers, tables

SCHEMAS = {
    "urls": "url string, namespace string, confirmed boolean, lastmod string, last_scraped timestamp, page_template_type string",
    "doms": "url string, scrape_status string, html string, content_sha256 string, content_length bigint, status_code int, fetched_at timestamp, first_fetched_at timestamp, attempts bigint, last_error string, last_error_kind string",
    "parse_failures": "url string, error string, error_type string, content_sha256 string, failed_at timestamp, attempts int, parser_version string, policy_version string",
    "dom_features": "url string, content_sha256 string, extractor_version int, tokens map<string,int>, n_tokens int, n_unique_tokens int, n_nodes int, max_depth int, cluster_run_id string, cluster_id int, cluster_probability double",
    "dom_clusters": "run_id string, cluster_id int, size bigint, top_tokens array<struct<token:string,weight:double>>, medoid_url string, sample_urls array<string>, namespaces map<string,bigint>",
    "cluster_runs": "run_id string, started_at timestamp, finished_at timestamp, params string, metrics string, n_docs bigint",
    "run_summaries": "key string, stage string, run_id string, created_at timestamp, updated_at timestamp, summary string",
}
PARSER_VERSION, EXTRACTOR_VERSION = "1", 1


def run_id(at: datetime) -> str:
    return at.astimezone(timezone.utc).strftime("run_%Y%m%dT%H%M%SZ")


class Corpus:
    """now: the time that a stage stamps; given for tests, else the clock's."""

    def __init__(self, spark: SparkSession, path: str, site: SiteProfile = DEFAULT_SITE, policy: pages.Policy = pages.Policy(), now: datetime | None = None):
        self.spark, self.path, self.site, self.policy, self._now = spark, path, site, policy, now

    def now(self) -> datetime:
        return self._now or datetime.now(timezone.utc)

    def table(self, name: str) -> merge.VersionedTable:
        t = merge.VersionedTable(self.spark, f"{self.path}/{name}")
        if not t.version() and name in SCHEMAS:
            t.write(self.spark.createDataFrame([], SCHEMAS[name]))
        return t

    def read(self, name: str) -> DataFrame:
        return self.table(name).read()

    def _held(self, df: DataFrame, name: str) -> DataFrame:
        return Workspace(self.spark, name).write(df, name)

    # -- discovery

    def discover(self, entries: DataFrame) -> dict[str, int]:
        """Merges sitemap entries (url, lastmod) whose lastmod changed; the last of a url in order of lastmod holds."""
        known = self.read("urls")
        found = entries.where("url is not null").groupBy("url").agg(F.max("lastmod").alias("lastmod"))
        changed = self._held(discovery.changed_entries(found, known), "changed")
        batch = changed.select("url", namespace(F.col("url"), self.site).alias("namespace"), "confirmed", F.when(F.col("confirmed"), F.col("lastmod")).alias("lastmod"))
        return self.table("urls").merge(batch, "url", merge.DISCOVERY_RULES)

    def crawl(self, transport: readers.Transport, config: readers.CrawlConfig = readers.CrawlConfig()) -> dict[str, int]:
        """Follows the site's listings, in their order, and adds the entry urls that aren't known yet."""
        listings = self.spark.createDataFrame([(*listing, n) for n, listing in enumerate(self.site.listings)], "path string, confirmed boolean, place int")
        found = self._held(readers.crawl_listing(self.spark, listings, transport, self.read("urls"), self.site, config), "crawled")
        batch = found.select("url", namespace(F.col("url"), self.site).alias("namespace"), "confirmed", F.lit(None).cast("string").alias("lastmod"))
        return self.table("urls").merge(batch, "url", merge.DISCOVERY_RULES)

    def infer_site(self) -> SiteProfile:
        self.site = discovery.infer_site(self.read("urls"), self.site)
        return self.site

    # -- scraping

    def pending_scrape(self, limit: int = 0, namespaces=None, confirmed_only: bool = True, refetch_days: int = 0, most_attempts: int = 3) -> DataFrame:
        urls = select.in_namespaces(self.read("urls"), select.namespace_names(namespaces), check=True)
        urls = add_utc_micros(urls.where("confirmed") if confirmed_only else urls, "lastmod_us", F.col("lastmod"), F.lit("UTC"), known_zones(self.spark))
        urls = urls.withColumn("lastmod", F.timestamp_micros("lastmod_us"))
        cutoff = F.lit(self.now()) - F.make_interval(days=F.lit(refetch_days)) if refetch_days else None
        return select.first_pending(select.scrape_buckets(urls, self.read("doms").withColumnRenamed("fetched_at", "fetched"), cutoff, most_attempts), limit)

    def scrape(self, transport: readers.Transport, config: readers.FetchConfig = readers.FetchConfig(), **selection) -> dict[str, int]:
        """Fetches what is pending and folds the outcomes onto the stored pages."""
        outcomes = self._held(readers.fetch(self.pending_scrape(**selection), transport, config), "outcomes")
        return self.save_outcomes(outcomes)

    def save_outcomes(self, outcomes: DataFrame) -> dict[str, int]:
        """outcomes: one row for each url, as fetch gives them. A failed one never replaces a page."""
        old = self.read("doms")
        good = F.col("ok") & F.col("html").isNotNull() & (F.col("html") != "")
        o = outcomes.where("url is not null").join(old.select("url", "scrape_status", F.col("html").isNotNull().alias("had_html")), "url", "left")
        held = F.coalesce((F.col("scrape_status") == "ok") & F.col("had_html"), F.lit(False))
        when_good = lambda c: F.when(good, c)
        batch = o.select(
            "url", F.when(good | held, "ok").otherwise("failed").alias("scrape_status"), when_good(F.col("html")).alias("html"), when_good(F.sha2("html", 256)).alias("content_sha256"), when_good(F.octet_length("html").cast("bigint")).alias("content_length"), when_good(F.col("status_code")).alias("status_code"),
            when_good(F.lit(self.now())).alias("fetched_at"), when_good(F.lit(self.now())).alias("first_fetched_at"), F.col("attempts_used").cast("bigint").alias("attempts"), F.when(~good, F.coalesce("error", F.lit("empty page"))).alias("last_error"), F.when(~good, F.coalesce("error_kind", F.lit("retryable"))).alias("last_error_kind"),
            F.when(good, "ok").when(held, "kept_ok").otherwise("failed").alias("outcome"),
        )
        batch = self._held(batch, "batch")
        rules = dict.fromkeys(("html", "content_sha256", "content_length", "status_code", "fetched_at"), merge.new_if_given) | {"first_fetched_at": merge.keep_old, "attempts": merge.added}
        self.table("doms").merge(batch.drop("outcome"), "url", rules)
        stamps = batch.where("outcome = 'ok'").select("url", F.lit(self.now()).alias("last_scraped"))
        self.table("urls").merge(stamps, "url", {}, insert=False)
        return {"ok": 0, "failed": 0, "kept_ok": 0} | {r[0]: r[1] for r in batch.groupBy("outcome").count().collect()}

    # -- parsing

    def pending_parse(self, force: bool = False, limit: int = 0, namespaces=None, confirmed_only: bool = True) -> DataFrame:
        """url, content_sha256 of the good pages that no entry and no dead letter of this hash, parser and policy answers."""
        urls = select.in_namespaces(self.read("urls"), select.namespace_names(namespaces))
        wanted = (urls.where("confirmed") if confirmed_only else urls).select("url")
        c = tables.content_hashes(self.read("doms"), wanted).withColumns({"parser_version": F.lit(PARSER_VERSION), "policy_version": F.lit(self.policy.version)})
        keys = ["url", "content_sha256", "parser_version", "policy_version"]
        done = [self.read("parse_failures").select(keys)]
        if self.table("entries").version():
            done.append(self.read("entries").select(F.col("source_url").alias("url"), *keys[1:]))
        out = (c if force else select.pending_versions(c, done, keys)).select("url", "content_sha256").orderBy("url")
        return out.limit(limit) if limit else out

    def parse(self, **selection) -> dict[str, int]:
        """Parses what is pending: records are merged into the entries, pages that don't validate into the dead letters, from which pages that
        now parse are removed."""
        asked = self._held(self.pending_parse(**selection), "asked")
        parsed = self._held(pages.parse_pages(tables.stored_pages(self.read("doms"), asked), self.site), "parsed")
        entries, failures = pages.entries_and_failures(parsed, PARSER_VERSION, self.policy, self.site)
        entries = self._held(entries.withColumn("parsed_at", F.lit(self.now())), "entries")
        self.table("entries").merge(entries, "source_url", {})
        new = self._held(failures, "failures")
        batch = new.select("url", F.left("error", F.lit(2000)).alias("error"), "error_type", "content_sha256", F.lit(self.now()).alias("failed_at"), F.lit(1).alias("attempts"), "parser_version", "policy_version")
        merged = merge.keyed_merge(self.read("parse_failures"), batch, "url", {"attempts": merge.added}).drop("__outcome")
        self.table("parse_failures").write(merged.join(entries.select(F.col("source_url").alias("url")), "url", "left_anti"))
        tally = {r[0]: r[1] for r in entries.groupBy("corpus_status").count().collect()}
        seen = asked.count()
        out = {"asked": seen, "ready": tally.get("ready", 0), "incomplete": tally.get("incomplete", 0), "failed": new.count()}
        return out | {"skipped": seen - out["ready"] - out["incomplete"] - out["failed"]}

    def sample_report(self, sample: int = 100) -> dict:
        """What parsing finds on some of the stored pages, chosen by a hash; nothing is written."""
        some = tables.stored_pages(self.read("doms")).orderBy(F.xxhash64("url")).limit(sample)
        parsed = self._held(pages.parse_pages(some, self.site), "sampled")
        return reports.parse_report(*pages.entries_and_failures(parsed, PARSER_VERSION, self.policy, self.site))

    def failures_by_namespace(self) -> DataFrame:
        return reports.by_group(select.with_namespace(self.read("parse_failures").select("url"), self.read("urls").select("url", "namespace"), fallback_namespace(F.col("url"), self.site)), F.col("namespace"))

    # -- structure and clusters

    def extract(self, limit: int = 0) -> dict[str, int]:
        """Structure tokens of the good pages whose hash or extractor changed; assignments of earlier runs stay."""
        c = tables.content_hashes(self.read("doms")).withColumn("extractor_version", F.lit(EXTRACTOR_VERSION))
        asked = select.pending_versions(c, [self.read("dom_features")], ["url", "content_sha256", "extractor_version"]).select("url", "content_sha256")
        asked = asked.orderBy("url").limit(limit) if limit else asked
        found = self._held(pages.structure_tokens(tables.stored_pages(self.read("doms"), asked), "url").join(asked, "url"), "tokens")
        batch = found.where("error is null").select("url", "content_sha256", F.lit(EXTRACTOR_VERSION).alias("extractor_version"), "tokens", "n_tokens", "n_unique_tokens", "n_nodes", "max_depth")
        done = self.table("dom_features").merge(batch, "url", {})
        return done | {"failed": found.where("error is not null").count()}

    def cluster(self, config: clustering.Config = clustering.Config(), write_back: bool = False) -> dict:
        """One clustering run: assignments go to the features, a row for each cluster and one for the run are kept, and with write_back the
        urls bear their template's name."""
        started, rid = self.now(), run_id(self.now())
        tokens = self._held(features.token_counts(tables.feature_tokens(self.read("dom_features"), EXTRACTOR_VERSION), "url"), "token_counts")
        reduced = clustering.reduce_tokens(tokens, "url", config)
        done, metrics = clustering.run(tokens, "url", config, reduced)
        stamp = done.select("url", F.lit(rid).alias("cluster_run_id"), F.col("label").cast("int").alias("cluster_id"), F.col("probability").alias("cluster_probability"))
        self.table("dom_features").merge(stamp, "url", {}, insert=False)
        self._replace("dom_clusters", rid, self.cluster_documents(done, tokens, config, rid))
        run = [(rid, started, self.now(), json.dumps(config.__dict__), json.dumps(metrics), metrics["n_docs"])]
        self._replace("cluster_runs", rid, self.spark.createDataFrame(run, SCHEMAS["cluster_runs"]))
        clustering.model_of(done, reduced[2], config.binary).save(f"{self.path}/models/{rid}")
        matched = 0
        if write_back:
            names = clustering.template_names(done.select("url", "label")).select("url", "page_template_type")
            matched = self.table("urls").merge(names, "url", {}, insert=False)["updated"]
        return metrics | {"run_id": rid, "matched": matched}

    def assign(self, rid: str) -> dict[str, int]:
        """Gives pages that no run has clustered to the clusters of a kept run, or to its noise."""
        new = self.read("dom_features").where("cluster_run_id is null").select("url", "tokens", "extractor_version")
        tokens = self._held(features.token_counts(tables.feature_tokens(new, EXTRACTOR_VERSION), "url"), "new_tokens")
        found = clustering.Model.load(self.spark, f"{self.path}/models/{rid}").assign(tokens, "url")
        stamp = self._held(found.select("url", F.lit(rid).alias("cluster_run_id"), F.col("label").cast("int").alias("cluster_id")), "assigned")
        return self.table("dom_features").merge(stamp, "url", {}, insert=False)

    def clusters(self, rid: str) -> DataFrame:
        """The clusters of a run in the order of reports: the largest first, noise last."""
        return clustering.by_size(self.read("dom_clusters").where(F.col("run_id") == rid), "cluster_id")

    def cluster_documents(self, done: DataFrame, tokens: DataFrame, config: clustering.Config, rid: str) -> DataFrame:
        """A row for each cluster, noise included: size, distinguishing tokens, medoid, samples, namespaces."""
        weights = features.tfidf(tokens, "url", config.min_df, config.binary)
        top = features.top_tokens(weights, done.select("url", "label"), "url").groupBy("label").agg(F.array_sort(F.collect_list(F.struct("rank", "token", F.col("contrast").alias("weight")))).alias("t"))
        names = done.select("url", "label").join(self.read("urls").select("url", "namespace"), "url", "left").groupBy("label", reports.label_or_unknown(F.col("namespace")).alias("ns")).agg(F.count(F.lit(1)).alias("n"))
        names = names.groupBy("label").agg(F.sum("n").alias("size"), F.map_from_entries(F.collect_list(F.struct("ns", "n"))).alias("namespaces"))
        out = names.join(top, "label", "left").join(clustering.medoids(done, "url").select("label", F.col("medoid").alias("medoid_url")), "label", "left").join(clustering.samples(done, "url"), "label", "left")
        tokens_ = F.transform(F.coalesce("t", F.array().cast("array<struct<rank:int,token:string,weight:double>>")), lambda x: F.struct(x["token"].alias("token"), x["weight"].alias("weight")))
        return out.select(F.lit(rid).alias("run_id"), F.col("label").cast("int").alias("cluster_id"), "size", tokens_.alias("top_tokens"), "medoid_url", F.col("samples").alias("sample_urls"), "namespaces")

    def _replace(self, name: str, rid: str, rows: DataFrame) -> None:
        t = self.table(name)
        t.write(t.read().where(F.col("run_id") != rid).unionByName(rows))

    # -- summaries

    def stats(self) -> dict[str, dict]:
        """The counts of each table."""
        one = lambda df, **c: reports.counts(df, **c).first().asDict()
        d, u = self.read("doms"), self.read("urls")
        out = {
            "urls": one(u, total=F.lit(True), confirmed=F.col("confirmed"), lastmod_null=F.col("lastmod").isNull()),
            "doms": one(d, total=F.lit(True), ok=F.col("scrape_status") == "ok", failed=F.col("scrape_status") == "failed", permanent=F.col("last_error_kind") == "permanent"),
            "failures": {r[0]: r[1] for r in reports.by_group(self.read("parse_failures"), F.col("error_type")).collect()}, "failures_by_namespace": {r[0]: r[1] for r in self.failures_by_namespace().collect()},
            "namespaces": {r[0]: r[1] for r in reports.by_group(u, reports.label_or_unknown(F.col("namespace"))).collect()},
        }
        f = self.read("dom_features")
        out["features"] = one(f, total=F.lit(True), clustered=F.col("cluster_run_id").isNotNull(), noise=F.col("cluster_id") == clustering.NOISE) | {"versions": {r[0]: r[1] for r in reports.by_group(f, F.col("extractor_version")).collect()}}
        latest = self.read("cluster_runs").orderBy(F.col("started_at").desc(), F.col("run_id").desc()).first()
        out["latest_run"] = None if latest is None else {"run_id": latest["run_id"], "n_docs": latest["n_docs"], **json.loads(latest["metrics"])}
        if self.table("entries").version():
            e = self.read("entries")
            out["entries"] = one(e, total=F.lit(True), ready=F.col("corpus_status") == "ready")
            out["missing"] = {r[0]: r[1] for r in reports.by_group(e.select(F.explode("corpus_missing").alias("m")), F.col("m")).collect()}
        return out

    def save_summary(self, stage: str, rid: str, summary: dict) -> str:
        """One row for each stage and run; the time it was first saved stays."""
        key = f"{stage}:{rid}"
        row = self.spark.createDataFrame([(key, stage, rid, self.now(), self.now(), json.dumps(summary, default=str))], SCHEMAS["run_summaries"])
        self.table("run_summaries").merge(row, "key", {"created_at": merge.keep_old})
        return key

    def history(self, stage: str, limit: int = 300) -> DataFrame:
        """The last summaries of a stage, oldest first."""
        return reports.last_n(self.read("run_summaries").where(F.col("stage") == stage), ["created_at", "key"], limit)

    def trends(self, stage: str) -> DataFrame:
        """The series of a stage's numbers over its runs."""
        h = self.history(stage)
        flat = reports.flatten(h, "key", "summary").where("trend").select("key", "path", "value")
        return reports.trend_series(flat.join(h.select("key", F.col("created_at").alias("at")), "key").select("path", "at", "value"))
