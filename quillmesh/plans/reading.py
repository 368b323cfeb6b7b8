"""Queries on the readers and on the stages of a corpus: what the tables hold is written in the forms that sites and tools give - pages, sitemaps,
robots files, JSON indexes, triples - and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmesh.corpus import Corpus
from quillmesh.operators import pages, rdf
from quillmesh.plans.problems import read
from quillmesh.session import shared_folder
from quillmesh.site import STATUSES
from quillmesh.sources import readers, tables


def _place(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def _escaped(text: Column) -> Column:
    out = F.coalesce(text, F.lit(""))
    for plain, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        out = F.replace(out, F.lit(plain), F.lit(entity))
    return out


def _told(*parts: Column | str) -> Column:
    return F.concat(*(F.lit(p) if isinstance(p, str) else p for p in parts))


def _each(items: Column, *parts) -> Column:
    """The parts for each item; a part that is a function takes the item."""
    given = F.filter(F.coalesce(items, F.array().cast("array<string>")), lambda x: x.isNotNull())
    return F.array_join(F.transform(given, lambda x: _told(*(p(x) if callable(p) else p for p in parts))), "")


def _entry_pages(entries: DataFrame) -> DataFrame:
    """An entry page for each row of entries."""
    c, number = F.col, F.col("entry_id").cast("string")
    html = _told(
        '<html><head><title>x</title><link rel="canonical" href="', c("url"), '"><meta property="og:title" content="', _escaped(c("title")), ' | Meme Archive"><meta property="og:image" content="https//img.example/', number, '.png"></head><body><h1 class="entry-title">', _escaped(c("title")), '</h1><h5 class="parent"><a href="/memes/p', number, '#top">Parent</a></h5>',
        "<dl><dt>Status</dt><dd>", _escaped(c("status")), "</dd><dt>Year:</dt><dd>c. ", F.coalesce(c("year").cast("string"), F.lit("?")), "</dd><dt>Origin</dt><dd>", _escaped(c("origin")), "</dd><dt>Type:</dt><dd>", _each(c("entry_type"), '<a href="', _escaped, '">x</a>, '), "</dd><dt>Region</dt><dd>", F.array_join(F.transform(F.coalesce("region", F.array().cast("array<string>")), _escaped), " , "), "</dd><dt>Badges:</dt><dd>NSFW, b", number, "</dd></dl>",
        '<dl id="entry_tags"><dt>Tags</dt><dd>', _each(c("tags"), '<a data-tag="1">', _escaped, "</a> "), '</dd><dt>Additional References</dt><dd><a href="https;//ref.example/', number, '">Ref</a><a href="javascript:x">no</a></dd></dl>',
        '<section class="bodycopy"><p>lead</p><h2 id="about">All about it</h2><p>', _escaped(c("title")), '</p><img data-src="/i/', number, '.png" alt="A"><img src="/assets/blank-1.gif"><table><tr><td>t</td></tr></table><h2>Origins:</h2><p>From <a href="/memes/q', number, '#x">there</a></p><h4>Template</h4></section>',
        '<div class="references"><a href="#r1">[7]</a><a href="https://x.example/', number, '">One</a><a href="https://y.example/', number, '">Two</a></div><div class="entry-timestamps">Updated <abbr class="timeago" title="', F.date_format("parsed_at", "yyyy-MM-dd'T'HH:mm:ss'Z'"), '">x</abbr> Added <abbr class="timeago" title="2020-02-03T04:05:06+01:00">y</abbr></div></body></html>',
    )
    return entries.select("url", html.alias("html"), number.alias("content_sha256"))


def entry_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every entry written as a page and parsed again: the fields of the record, nested ones flattened."""
    entries = read(spark, sf_dir, "entries").where("url is not null and parsed_at is not null")
    found, _ = pages.entries_and_failures(pages.parse_pages(_entry_pages(entries)), "1")
    joined = lambda c: F.array_join(c, "|")
    return found.select(
        F.col("content_sha256").cast("bigint").alias("entry_id"), "url", "title", "status", "year", "origin", joined("entry_type").alias("types"), joined("region").alias("regions"), joined("tags").alias("tags"), joined("badges").alias("badges"), "og_image", "series_parent", joined("additional_references.url").alias("more"),
        joined(F.transform("external_references", lambda r: F.concat(F.coalesce(r["index"].cast("string"), F.lit("-")), F.lit(" "), r["url"]))).alias("cited"), joined(F.transform("sections", lambda s: F.concat_ws(" ", s["kind"], s["level"].cast("string"), F.size(s["text"]).cast("string")))).alias("sections"),
        joined(F.flatten(F.transform("sections", lambda s: s["images"]["src"]))).alias("images"), joined(F.flatten(F.transform("sections", lambda s: s["links"]["url"]))).alias("links"), F.col("meta")["og:title"].alias("og_title"), "updated", "added", joined("corpus_missing").alias("missing"), "corpus_status",
    )


def entry_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The facts of the stored pages that are entries."""
    doms = read(spark, sf_dir, "doms").select("dom_id", "url", "html").where("html is not null")
    parsed = pages.parse_pages(doms.select("url", "html", F.col("dom_id").cast("string").alias("content_sha256")))
    found, _ = pages.entries_and_failures(parsed, "1")
    return found.select(F.col("content_sha256").cast("bigint").alias("dom_id"), "source_url", "url", "status", "year", "origin")


def structure_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each element with its classes occurs, on how many pages."""
    t = pages.structure_tokens(read(spark, sf_dir, "doms").select("dom_id", "html")).select(F.explode("tokens").alias("token", "count"))
    return t.where(~F.col("token").contains(">")).groupBy("token").agg(F.sum("count").alias("total"), F.count(F.lit(1)).alias("pages"))


def structure_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.structure_tokens(read(spark, sf_dir, "doms").select("dom_id", "html")).where("error is null").select("dom_id", "n_nodes", "truncated")


def sitemap_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All urls, written as gzipped sitemaps and read again."""
    urls = read(spark, sf_dir, "urls").where("url is not null").select("url", "lastmod", F.pmod(F.xxhash64("url_id"), F.lit(64)).alias("file"))
    entry = _told("<url><loc> ", _escaped(F.col("url")), "\n</loc>", F.coalesce(_told("<lastmod>", _escaped(F.col("lastmod")), "</lastmod>"), F.lit("")), "</url>")
    whole = urls.groupBy("file").agg(_told('<?xml version="1.0" encoding="UTF-8"?><urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">', F.array_join(F.collect_list(entry), ""), "</urlset>").alias("xml"))
    place = _place(spark, "sitemaps")
    whole.repartition(64, "file").write.partitionBy("file").text(place, compression="gzip")
    return readers.sitemap_files(spark, place).where("kind = 'url'").select(F.col("loc").alias("url"), "lastmod")


def robots_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sitemaps that a robots file names, one for each namespace."""
    names = read(spark, sf_dir, "urls").where("namespace is not null").select("namespace").distinct()
    place = _place(spark, "robots")
    names.select(_told("SiteMap:  https://memearchive.example/", F.col("namespace"), ".xml ").alias("value")).unionByName(spark.createDataFrame([("User-agent: *",), ("# Sitemap: no",), ("Sitemap:",)], "value string")).write.text(place)
    return readers.robots_sitemaps(spark, place, "https://memearchive.example/sitemap.xml")


def json_index_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The urls from indexes in JSON, a list or an object with a list in each file."""
    urls = read(spark, sf_dir, "urls").where("url is not null").groupBy("url").agg(F.max("url_id").alias("url_id"), F.max_by("confirmed", "url_id").alias("confirmed"))
    listed = urls.groupBy(F.pmod(F.xxhash64("url"), F.lit(64)).alias("file")).agg(F.to_json(F.collect_list(F.struct("url", "url_id", "confirmed"))).alias("list"))
    place = _place(spark, "index")
    wrapped = F.when(F.col("file") % 2 == 0, F.col("list")).otherwise(_told('{"urls":', F.col("list"), "}"))
    listed.select(wrapped.alias("value"), F.col("file").alias("part")).repartition(64, "part").write.partitionBy("part").text(place)
    return readers.json_index(spark, place, "url string, url_id bigint, confirmed boolean")


def triple_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The entries as N-Triples, read again: of each title the class and, where there is one, the year."""
    e = read(spark, sf_dir, "entries").where("title is not null")
    s = _told("<urn:entry:", F.col("entry_id").cast("string"), "> <urn:")
    quoted = F.regexp_replace(F.regexp_replace("title", r"\\", r"\\\\"), '"', r'\\"')
    lines = F.array_compact(F.array(_told(s, "is> <urn:class:", F.regexp_replace(F.coalesce("category", F.lit("none")), " ", "_"), "> ."), _told(s, 'title> "', quoted, '"@en .'), _told(s, 'year> "', F.col("year").cast("string"), '" .'), F.lit("# no triple")))
    place = _place(spark, "triples")
    e.select(F.explode(lines).alias("value")).write.text(place)
    t = readers.triples(spark, place)
    members = t.where("p = 'urn:is'").select("s", F.col("o").alias("class"))
    return rdf.with_optional(members, t, year="urn:year").select(F.regexp_extract("s", r"(\d+)$", 1).cast("bigint").alias("entry_id"), "class", F.regexp_replace("year", '"', "").cast("int").alias("year"))


def stored_page_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known confirmed urls with their good pages."""
    urls = read(spark, sf_dir, "urls").where("url is not null").groupBy("url").agg(F.max("confirmed").alias("confirmed"), F.max("namespace").alias("namespace"))
    found = tables.pages_of(urls, read(spark, sf_dir, "doms"))
    return found.select("url", "namespace", "content_sha256", F.length("html").alias("n_chars"))


def hash_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hashes of the good pages of urls that discovery knows."""
    return tables.content_hashes(read(spark, sf_dir, "doms"), tables.known_urls(read(spark, sf_dir, "urls")))


def feature_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.feature_tokens(read(spark, sf_dir, "dom_features"), 1).select("url", F.size("tokens").alias("n"))


def _stored_corpus(spark: SparkSession, sf_dir: str) -> Corpus:
    """A corpus that knows the urls of doms and holds of each the page that was stored last."""
    corpus = Corpus(spark, _place(spark, "corpus"))
    doms = read(spark, sf_dir, "doms").where("url is not null and html is not null").groupBy("url").agg(F.max_by("html", "dom_id").alias("html"))
    corpus.discover(doms.select("url", F.lit(None).cast("string").alias("lastmod")))
    corpus.save_outcomes(doms.select("url", F.lit(True).alias("ok"), "html", F.lit(200).alias("status_code"), F.lit(None).cast("string").alias("error"), F.lit(None).cast("string").alias("error_kind"), F.lit(1).alias("attempts_used")))
    return corpus


def corpus_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the parse stage makes of the stored pages, run twice: entries, and dead letters that the second run leaves alone."""
    corpus = _stored_corpus(spark, sf_dir)
    corpus.parse(confirmed_only=False)
    corpus.parse(confirmed_only=False)
    letters = corpus.read("parse_failures").select("url", F.lit("failure").alias("result"), F.col("error").alias("told"), "attempts")
    if not corpus.table("entries").version():
        return letters
    return letters.unionByName(corpus.read("entries").select(F.col("source_url").alias("url"), F.lit("entry").alias("result"), F.col("origin").alias("told"), F.lit(1).alias("attempts")))


def corpus_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The features that the extract stage stores for the pages of a corpus."""
    corpus = _stored_corpus(spark, sf_dir)
    corpus.extract()
    corpus.extract()
    return corpus.read("dom_features").select("url", "content_sha256", "extractor_version", "n_nodes")


QUERIES = {f.__name__: f for f in (entry_round_trip, entry_facts, structure_elements, structure_sizes, sitemap_scan, robots_scan, json_index_scan, triple_scan, stored_page_scan, hash_scan, feature_scan, corpus_parse, corpus_extract)}

_IN = ", ".join(f"'{s}'" for s in STATUSES)
_BARE = r"""regexp_replace(regexp_replace(html, '(?s)<!--.*?-->', '', 'g'), '(?si)<(script|style|noscript|template)(\s[^>]*)?>.*?</(script|style|noscript|template)\s*>', '', 'g')"""
_TAGS = rf"""t as (select dom_id, unnest(regexp_extract_all(b, '<([a-zA-Z][a-zA-Z0-9]*(\s([^<>"'']|"[^"]*"|''[^'']*'')*|/)?)>', 1)) as tag from (select dom_id, {_BARE} as b from doms where html is not null and trim(html) <> '')),
k as (select dom_id, lower(regexp_extract(tag, '^[a-zA-Z0-9]+')) as tag, string_split_regex(trim(regexp_extract(tag, 'class\s*=\s*("([^"]*)"|''([^'']*)''|([^\s>"'']+))', 1), '"'''), '\s+') as cls from t),
e as (select dom_id, tag, array_to_string(list_concat([tag], list_sort(list_distinct(list_filter(cls, lambda c: c <> '' and not regexp_matches(c, '[0-9]'))))[:3]), '.') as token from k where tag not in ('br', 'wbr', 'iframe', 'svg', 'path', 'g', 'defs', 'use', 'symbol', 'circle', 'rect', 'line', 'polygon', 'polyline', 'ellipse'))"""
_LAST = "l as (select url, html from doms where url is not null and html is not null qualify row_number() over (partition by url order by dom_id desc) = 1)"
ORACLES = {
    "entry_round_trip": rf"""with b as (select * from entries where url is not null and parsed_at is not null and trim(coalesce(origin, '')) <> '' and regexp_matches(url, '^https?://(www\.)?memearchive\.example(/|$)')),
t as (select entry_id, array_to_string(list_transform(list_filter(entry_type, lambda x: x is not null and x <> ''), lambda x: case when regexp_extract(x, '/types/([a-z0-9-]+)', 1) <> '' then regexp_extract(x, '/types/([a-z0-9-]+)', 1) else replace(lower(trim(x)), ' ', '-') end), '|') as types from b),
u as (select entry_id, 'tags' as what, trim(regexp_replace(unnest(tags), '\s+', ' ', 'g')) as x, unnest(range(len(tags))) as pos from b union all select entry_id, 'regions', trim(regexp_replace(unnest(region), '\s+', ' ', 'g')), unnest(range(len(region))) from b),
v as (select entry_id, what, lower(x) as k, min(pos) as pos, arg_min(x, pos) as x from u where x <> '' group by all), w as (select entry_id, string_agg(x, '|' order by pos) filter (what = 'tags') as tags, string_agg(x, '|' order by pos) filter (what = 'regions') as regions from v group by entry_id),
f as (select b.*, coalesce(t.types, '') as types, coalesce(w.tags, '') as ts, coalesce(w.regions, '') as rs, trim(regexp_replace(coalesce(title, ''), '\s+', ' ', 'g')) as ti from b left join t using (entry_id) left join w using (entry_id)),
g as (select *, list_filter([case when year is null then 'year' end, case when types = '' then 'entry_type' end, case when rs = '' then 'region' end, case when ts = '' then 'tags' end, 'section:spread'], lambda x: x is not null) as lack from f)
select entry_id, url, ti as title, case when lower(trim(status)) in ({_IN}) then lower(trim(status)) else 'unknown' end as status, year, trim(regexp_replace(origin, '\s+', ' ', 'g')) as origin, types, rs as regions, ts as tags, 'NSFW|b' || entry_id as badges, 'https://img.example/' || entry_id || '.png' as og_image, 'https://memearchive.example/memes/p' || entry_id as series_parent, 'https://ref.example/' || entry_id as more,
'7 https://x.example/' || entry_id || '|- https://y.example/' || entry_id as cited, case when ti = '' then 'about 2 0' else 'about 2 1' end || '|origin 2 1|template 3 0' as sections, 'https://memearchive.example/i/' || entry_id || '.png' as images, 'https://memearchive.example/memes/q' || entry_id as links, coalesce(title, '') || ' | Meme Archive' as og_title, epoch(date_trunc('second', parsed_at))::bigint as updated, 1580699106 as added, array_to_string(lack, '|') as missing, 'incomplete' as corpus_status from g""",
    "entry_facts": rf"""with f as (select dom_id, url as source_url, coalesce(nullif(regexp_extract(html, '<link rel="canonical" href="([^"]*)"', 1), ''), url) as url, trim(regexp_extract(html, '<dt>Status</dt><dd>([^<]*)</dd>', 1)) as s, trim(regexp_extract(html, '<dt>Year</dt><dd>([^<]*)</dd>', 1)) as y, trim(regexp_extract(html, '<dt>Origin</dt><dd>([^<]*)</dd>', 1)) as origin from doms where html is not null)
select dom_id, source_url, url, case when lower(s) in ({_IN}) then lower(s) else 'unknown' end as status, nullif(regexp_extract(y, '(\d{{4}})', 1), '')::int as year, origin from f where origin <> '' and html_ok(url)""".replace("html_ok(url)", r"regexp_matches(url, '^https?://(www\.)?memearchive\.example(/|$)')"),
    "structure_elements": f"with {_TAGS} select token, count(*) as total, count(distinct dom_id) as pages from e group by token",
    "structure_sizes": f"with {_TAGS} select dom_id, count(*) as n_nodes, false as truncated from e group by dom_id",
    "sitemap_scan": r"select regexp_replace(url, '^\s+|\s+$', '', 'g') as url, nullif(regexp_replace(lastmod, '^\s+|\s+$', '', 'g'), '') as lastmod from urls where regexp_replace(url, '^\s+|\s+$', '', 'g') <> ''",
    "robots_scan": "select distinct 'https://memearchive.example/' || namespace || '.xml' as loc from urls where namespace is not null",
    "json_index_scan": "select url, url_id, confirmed from urls where url is not null qualify row_number() over (partition by url order by url_id desc) = 1",
    "triple_scan": "select entry_id, 'urn:class:' || replace(coalesce(category, 'none'), ' ', '_') as class, year from entries where title is not null",
    "stored_page_scan": "with u as (select url, bool_or(confirmed) as c, max(namespace) as namespace from urls where url is not null group by url) select url, u.namespace, content_sha256, length(html) as n_chars from doms join u using (url) where c and scrape_status = 'ok' and html is not null",
    "hash_scan": "select url, content_sha256 from doms where scrape_status = 'ok' and content_sha256 is not null and url in (select url from urls where url is not null)",
    "feature_scan": "select url, len(map_keys(tokens)) as n from dom_features where extractor_version = 1 and tokens is not null",
    "corpus_parse": rf"""with {_LAST}, p as (select url, html, trim(regexp_extract(html, '<dt>Origin</dt><dd>([^<]*)</dd>', 1)) as o from l where html <> '')
select url, case when o = '' then 'failure' else 'entry' end as result, case when o = '' then 'origin: missing' else o end as told, 1 as attempts from p""",
    "corpus_extract": f"""with {_LAST}, doms as (select url as dom_id, html from l), {_TAGS} select dom_id as url, sha256(l.html) as content_sha256, 1 as extractor_version, count(*) as n_nodes from e join l on l.url = dom_id group by all""",
}
