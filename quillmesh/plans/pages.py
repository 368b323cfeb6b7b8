"""Queries on stored pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmesh.operators import pages
from quillmesh.plans.problems import read


def _doms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "doms").select("dom_id", "url", "html", "content_sha256")


def entry_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each stored page as a normalised, graded record."""
    entries, _ = pages.entries_and_failures(pages.parse_pages(_doms(spark, sf_dir).where("html is not null")), "1")
    return entries.select("source_url", "url", "title", "category", "status", "year", "origin", F.array_join("corpus_missing", ",").alias("missing"), "corpus_status", F.size("sections").alias("n_sections"), F.size(pages.section_text("spread")).alias("n_spread"))


def entry_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, failures = pages.entries_and_failures(pages.parse_pages(_doms(spark, sf_dir)), "1")
    return failures.select("url", "error", "error_type", "content_sha256")


def entry_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = pages.normalise(pages.parse_pages(_doms(spark, sf_dir).where("html is not null")))
    return parsed.select("content_sha256", F.posexplode("sections").alias("pos", "s")).select("content_sha256", "pos", "s.heading", "s.kind", "s.level", F.size("s.text").alias("n_paragraphs"), F.size("s.links").alias("n_links"), F.size("s.images").alias("n_images"))


def page_meta_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.page_meta(_doms(spark, sf_dir))


def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.page_links(_doms(spark, sf_dir)).groupBy("dom_id").agg(F.count(F.lit(1)).alias("n_links"), F.count_if("is_entry").alias("n_entries"))


def structure_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.structure_tokens(_doms(spark, sf_dir)).select("dom_id", "n_tokens", "n_unique_tokens", "n_nodes", "max_depth", "error")


def structure_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = pages.structure_tokens(_doms(spark, sf_dir)).select(F.explode("tokens").alias("token", "count"))
    return t.groupBy("token").agg(F.sum("count").alias("total"), F.count(F.lit(1)).alias("pages"))


QUERIES = {f.__name__: f for f in (entry_parse, entry_failures, entry_sections, page_meta_extract, page_links, structure_tokens, structure_token_counts)}
_LINKS = r"""with l as (select dom_id, unnest(regexp_extract_all(regexp_replace(regexp_replace(html, '(?s)<!--.*?-->', '', 'g'), '(?s)<(script|style|noscript|template|title)[^>]*>.*?</(script|style|noscript|template|title)>', '', 'g'), '<a href="([^"]*)"', 1)) as h from doms where html is not null),
d as (select distinct dom_id, case when starts_with(h, '/') then 'https://memearchive.example' || h else h end as link from l), """
ORACLES = {
    "page_meta_extract": r"""select dom_id, 'og:title' as name, regexp_extract(html, '<meta property="og:title" content="([^"]*)"', 1) as content from doms where regexp_extract(html, '<meta property="og:title" content="([^"]*)"', 1) <> ''""",
    "entry_failures": """with p as (select url, content_sha256, html, trim(regexp_extract(html, '<dt>Origin</dt><dd>([^<]*)</dd>', 1)) as o from doms)
select url, case when coalesce(html, '') = '' then 'empty page' else 'origin: missing' end as error, case when coalesce(html, '') = '' then 'ValueError' else 'ValidationError' end as error_type, content_sha256 from p where coalesce(html, '') = '' or o = ''""",
    "page_links": _LINKS + r"""s as (select dom_id, link, list_filter(string_split(regexp_extract(link, '^https?://[^/?#]*([^?#]*)', 1), '/'), lambda x: x <> '') as g from d)
select dom_id, count(*) as n_links, count_if(len(g) >= 2 and g[1] in ('memes', 'cultures', 'subcultures', 'people', 'sites', 'events', 'editorials', 'videos', 'photos', 'sensitive') and not regexp_matches(g[-1], '^[0-9]+$') and starts_with(link, 'https://memearchive.example') and g[-1] not in ('all', 'new', 'confirmed', 'submissions', 'people', 'events', 'sites', 'page')) as n_entries from s group by dom_id""",
}
