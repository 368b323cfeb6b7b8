"""Queries on the column functions: URLs, hashes, text fields."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmesh.functions import text as T
from quillmesh.functions import urls as U
from quillmesh.plans.problems import read
from quillmesh.site import CATEGORIES, CATEGORY_NAMES, DEFAULT_SITE, ENTRY_ROOTS, FALLBACK_NAMESPACES, LISTING_WORDS, NAMESPACES, STATUSES


def url_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "doms").where("html is not null")
    return d.select("dom_id", U.url_id(F.col("url")).alias("id"), U.content_hash(F.col("html")).alias("sha"), U.byte_length(F.col("html")).alias("n_bytes"), U.looks_like_page(F.col("html")).alias("plausible"))


def url_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = read(spark, sf_dir, "urls")
    return u.select("url_id", U.host(F.col("url")).alias("host"), U.path(F.col("url")).alias("path"), F.array_join(U.segments(F.col("url")), "|").alias("segments"), U.strip_query(F.concat("url", F.lit("?a=1#b"))).alias("plain"))


def entry_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = read(spark, sf_dir, "urls")
    return u.select("url_id", "url").where(U.is_entry_url(F.col("url")))


def namespace_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = read(spark, sf_dir, "urls")
    return u.select("url_id", U.namespace(F.col("url")).alias("label"), U.fallback_namespace(F.col("url")).alias("fallback"), U.category(F.col("url")).alias("category"))


_DAMAGE = "CASE url_id % 6 WHEN 0 THEN replace(url, 'https:', 'https;') WHEN 1 THEN replace(url, 'https:', 'HTTPS') WHEN 2 THEN concat('%7Bwidth:170px%7D', url) WHEN 3 THEN concat('  ', url, ' ') WHEN 4 THEN 'javascript:void(0)' ELSE concat(url, ' x') END"


def url_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """URLs damaged in six ways by their number, repaired."""
    u = read(spark, sf_dir, "urls").withColumn("damaged", F.expr(_DAMAGE))
    return u.select("url_id", U.repair(F.col("damaged")).alias("repaired"))


def link_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = read(spark, sf_dir, "urls").withColumn("href", F.concat(F.when(F.col("url_id") % 3 == 0, "").when(F.col("url_id") % 3 == 1, "https://other.example").otherwise("//cdn.example"), U.path(F.col("url")), F.lit("#top")))
    return u.select("url_id", U.absolute(F.col("href")).alias("absolute"), U.joined(F.col("url"), F.lit("../x?y=1")).alias("joined"))


def entry_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parsed records with normalised categories, statuses, years, types and tags."""
    e = read(spark, sf_dir, "entries")
    return e.select(
        "entry_id", T.enum(F.col("category"), CATEGORY_NAMES).alias("category"), T.enum(F.col("status"), STATUSES).alias("status"), T.year(F.concat(F.lit("c. "), F.col("year").cast("string"), F.lit(" AD"))).alias("year"),
        F.array_join(T.type_slug(F.filter("entry_type", lambda x: x.isNotNull())), "|").alias("types"), F.array_join(T.distinct_ignoring_case(F.filter("tags", lambda x: x.isNotNull())), "|").alias("tags"),
    )


def text_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "entries")
    return e.select(
        "entry_id", T.heading(F.concat(F.lit(" "), F.col("title"), F.lit(" "))).alias("heading"), T.without_suffix(F.concat("title", F.lit(DEFAULT_SITE.title_suffix)), DEFAULT_SITE.title_suffix).alias("title"), T.file_name(F.concat(F.lit("//"), "title", F.lit(" !"))).alias("file"), T.truncated(F.col("url"), 30).alias("short"),
        T.footnote(F.concat(F.lit("["), F.col("year").cast("string"), F.lit("]"))).alias("footnote"), T.heading_kind(F.lit(None).cast("string"), F.when(F.col("entry_id") % 3 == 0, "Origins: ").when(F.col("entry_id") % 3 == 1, "Template / GIF").otherwise(F.col("title"))).alias("kind"), F.array_join(T.comma_list(F.concat(F.col("title"), F.lit(" , b"))), "|").alias("parts"),
    )


def status_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = read(spark, sf_dir, "fetch_log")
    return f.groupBy(T.status_class(F.col("status_code")).alias("class"), "error_kind").agg(F.count(F.lit(1)).alias("n"), F.sum(T.backoff_cap(F.col("attempts_used"))).alias("longest_wait"))


def document_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Maps as lists of pairs: the token counts of each page, one row for each pair."""
    f = read(spark, sf_dir, "dom_features").select("feature_id", F.explode(T.references(F.map_filter("tokens", lambda _, n: n > 5).cast("map<string,string>"))).alias("r"))
    return f.select("feature_id", "r.name", "r.url")


def _case(text: str, patterns: list[tuple[str, str]], default: str) -> str:
    return "CASE " + " ".join(f"WHEN starts_with({text}, '{p}') THEN '{n}'" for p, n in patterns) + f" ELSE {default} END"


_IN = lambda words: ", ".join(f"'{w}'" for w in words)
_PATH = r"regexp_extract(url, '^[A-Za-z]+://[^/?#]*([^?#]*)', 1)"
_SEGS = f"list_filter(string_split({_PATH}, '/'), lambda s: s <> '')"
QUERIES = {f.__name__: f for f in (url_identity, url_parts, entry_url_filter, namespace_label, url_repair, link_resolve, entry_normalise, text_fields, status_classify, document_references)}
ORACLES = {
    "url_identity": "select dom_id, sha1(url) as id, sha256(html) as sha, octet_length(encode(html)) as n_bytes, octet_length(encode(html)) >= 2048 and contains(lower(left(html, 2048)), '<html') as plausible from doms where html is not null",
    "url_parts": f"select url_id, regexp_extract(url, '^[A-Za-z]+://([^/?#]*)', 1) as host, {_PATH} as path, array_to_string({_SEGS}, '|') as segments, url as plain from urls",
    "entry_url_filter": f"with s as (select url_id, url, {_SEGS} as g from urls) select url_id, url from s where len(g) >= 2 and g[1] in ({_IN(ENTRY_ROOTS)}) and g[-1] not in ({_IN(LISTING_WORDS)}) and not regexp_matches(g[-1], '^[0-9]+$')",
    "namespace_label": f"with p as (select url_id, {_PATH} as p, regexp_replace({_PATH}, '/+$', '') as q, regexp_replace({_PATH}, '^/sensitive', '') as c from urls) select url_id, {_case('q', [(f'/{n}/', n) for n in NAMESPACES], 'null')} as label, {_case('p', [(f'/{n}/', n) for n in FALLBACK_NAMESPACES], chr(39) + 'unknown' + chr(39))} as fallback, {_case('c', [(f'/{n}/', c) for n, c in CATEGORIES.items()], chr(39) + 'unknown' + chr(39))} as category from p",
    "url_repair": "select url_id, case when url_id % 6 in (4, 5) then null else url end as repaired from urls",
    "link_resolve": f"select url_id, case url_id % 3 when 0 then 'https://memearchive.example' || {_PATH} when 1 then 'https://other.example' || {_PATH} || '#top' else 'https://cdn.example' || {_PATH} end as absolute, 'https://memearchive.example/' || array_to_string(list_append(({_SEGS})[:len({_SEGS}) - 2], 'x?y=1'), '/') as joined from urls",
    "entry_normalise": rf"""with t as (select entry_id, array_to_string(list_transform(list_filter(entry_type, lambda x: x is not null), lambda x: case when regexp_extract(x, '/types/([a-z0-9-]+)', 1) <> '' then regexp_extract(x, '/types/([a-z0-9-]+)', 1) else replace(lower(trim(x)), ' ', '-') end), '|') as types from entries),
u as (select entry_id, trim(unnest(tags)) as x, unnest(range(len(tags))) as pos from entries), v as (select entry_id, lower(x) as k, min(pos) as pos, arg_min(x, pos) as x from u where x <> '' group by all), w as (select entry_id, string_agg(x, '|' order by pos) as tags from v group by entry_id)
select entry_id, case when lower(trim(category)) in ({_IN(CATEGORY_NAMES)}) then lower(trim(category)) else 'unknown' end as category, case when lower(trim(status)) in ({_IN(STATUSES)}) then lower(trim(status)) else 'unknown' end as status, year, t.types, case when e.tags is not null then coalesce(w.tags, '') end as tags from entries e join t using (entry_id) left join w using (entry_id)""",
    "text_fields": r"""select entry_id, left(trim(coalesce(title, '')), 120) as heading, title, coalesce(nullif(regexp_replace(regexp_replace(title, '[^A-Za-z0-9.\-]+', '_', 'g'), '^_+|_+$', '', 'g'), ''), 'x') as file, left(url, 30) as short, year as footnote,
case entry_id % 3 when 0 then 'origin' when 1 then 'template' else case when starts_with(lower(title), 'template') then 'template' else 'other' end end as kind, title || '|b' as parts from entries""",
    "status_classify": "select case when status_code = 200 then 'ok' when status_code in (401, 403) then 'auth' when status_code in (400, 404, 405, 422) then 'permanent' else 'retryable' end as class, error_kind, count(*) as n, sum(least(60.0, 2.0 * pow(2.0, attempts_used - 1))) as longest_wait from fetch_log group by all",
    "document_references": "with e as (select feature_id, unnest(map_entries(tokens)) as e from dom_features) select feature_id, e.key as name, e.value::varchar as url from e where e.value > 5",
}
