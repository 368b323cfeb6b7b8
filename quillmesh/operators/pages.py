"""Operators on stored pages: parsing to nested records with a dead letter for each page that fails, grading, links, structure tokens.

Pages are parsed in Arrow batches; normalising, validating and grading are column expressions on the parsed records. A page that can't
be read becomes a row with an error, never a failed task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmesh.functions import dom
from quillmesh.functions import text as T
from quillmesh.functions.urls import category, host, is_entry_url
from quillmesh.session import spread
from quillmesh.site import DEFAULT_SITE, STATUSES, SiteProfile

_LINK = "array<struct<text:string,url:string>>"
_IMAGE = "array<struct<src:string,alt:string,caption:string>>"
_REFS = "array<struct<name:string,url:string>>"
SECTIONS = f"array<struct<heading:string,kind:string,level:int,text:array<string>,links:{_LINK},images:{_IMAGE}>>"
RAW = (
    f"url string, title string, status string, year string, origin string, entry_type array<string>, region array<string>, aliases array<string>, tags array<string>, badges array<string>, og_image string, series_parent string, "
    f"additional_references {_REFS}, external_references array<struct<index:int,text:string,url:string>>, sections {SECTIONS}, meta map<string,string>, updated bigint, added bigint"
)
_NAMES = [f.split()[0] for f in "url,title,status,year,origin,entry_type,region,aliases,tags,badges,og_image,series_parent,additional_references,external_references,sections,meta,updated,added".split(",")]


def parse_pages(pages: DataFrame, site: SiteProfile = DEFAULT_SITE) -> DataFrame:
    """source_url, content_sha256, the raw record and error, error_type of each page (columns url, html, content_sha256). A null or empty page
    and one that can't be read give an error and no record. Small batches keep a worker at a few pages of memory."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for url, html, sha in zip(batch["url"], batch["html"], batch["content_sha256"], strict=True):
                record, error = dict.fromkeys(_NAMES), None
                try:
                    if not html:
                        raise ValueError("empty page")
                    record = dom.entry(html, url, site)
                except Exception as e:  # noqa: BLE001 - whatever a page does, the others go on
                    error = e
                rows.append((url, sha, *(record[k] for k in _NAMES), str(error) if error else None, type(error).__name__ if error else None))
            yield pd.DataFrame(rows, columns=["source_url", "content_sha256", *_NAMES, "error", "error_type"])

    return spread(pages.select("url", "html", "content_sha256")).mapInPandas(run, f"source_url string, content_sha256 string, {RAW}, error string, error_type string")


def normalise(parsed: DataFrame, site: SiteProfile = DEFAULT_SITE) -> DataFrame:
    """The parsed records with normalised fields, keyed by the page's own URL beside the one it was asked for."""
    c = F.col
    text_list = lambda n: T.distinct_ignoring_case(F.filter(n, lambda x: x.isNotNull()))
    fixed = F.transform("sections", lambda s: s.withField("heading", T.heading(s["heading"])).withField("text", T.paragraphs(s["text"])))
    return parsed.withColumns(
        {"category": category(c("url"), site), "status": T.enum(c("status"), STATUSES), "year": T.year(c("year")), "entry_type": T.type_slug(c("entry_type")), "region": text_list("region"), "aliases": text_list("aliases"), "tags": text_list("tags"), "badges": text_list("badges"), "sections": fixed}
    )


def invalid(site: SiteProfile = DEFAULT_SITE) -> Column:
    """Why a record doesn't validate, or null: a page of another host, no origin."""
    return F.when(F.col("error").isNotNull(), F.col("error")).when(~host(F.lower("url")).isin(*site.hosts), "url: host not allowed").when(F.coalesce(F.col("origin"), F.lit("")) == "", "origin: missing")


@dataclass(frozen=True)
class Policy:
    """What a record needs to be complete; a tunable gate, not a validity rule."""

    year: bool = True
    entry_type: bool = True
    region: bool = True
    tags: bool = True
    sections: tuple[str, ...] = ("about", "origin", "spread")
    version: str = "1"


def missing_fields(policy: Policy = Policy()) -> Column:
    """The ordered names of what a record lacks."""
    empty = lambda n: F.coalesce(F.size(n), F.lit(0)) <= 0
    kinds = F.coalesce(F.col("sections.kind"), F.array().cast("array<string>"))
    checks = [("year", policy.year, F.col("year").isNull()), *((n, getattr(policy, n), empty(n)) for n in ("entry_type", "region", "tags"))]
    found = [F.when(c, F.lit(n)) for n, wanted, c in checks if wanted] + [F.when(~F.array_contains(kinds, k), F.lit(f"section:{k}")) for k in policy.sections]
    return F.array_compact(F.array(*found)) if found else F.array().cast("array<string>")


def section_text(kind: str) -> Column:
    """The paragraphs of the first section of a kind, or none."""
    return F.coalesce(F.get(F.filter("sections", lambda s: s["kind"] == kind), F.lit(0))["text"], F.array().cast("array<string>"))


def with_parent(entries: DataFrame, *fields: str) -> DataFrame:
    """entries with parent_<field> of the entry that series_parent names, null where there is none. Of several rows of a URL the greatest counts."""
    parents = entries.where("url is not null").groupBy(F.col("url").alias("__p")).agg(F.max(F.struct(*fields)).alias("__f"))
    return entries.join(parents, F.col("series_parent") == F.col("__p"), "left").select(*(F.col(f"`{c}`") for c in entries.columns), *(F.col(f"__f.{f}").alias(f"parent_{f}") for f in fields))


def entries_and_failures(parsed: DataFrame, parser_version: str, policy: Policy = Policy(), site: SiteProfile = DEFAULT_SITE) -> tuple[DataFrame, DataFrame]:
    """(entries, failures) of parsed pages: graded records that validate, and a dead letter for each of the others."""
    n = normalise(parsed, site).withColumn("__why", invalid(site))
    missing = missing_fields(policy)
    entries = n.where("__why is null").withColumns({"corpus_missing": missing, "corpus_status": F.when(F.size(missing) == 0, "ready").otherwise("incomplete"), "parser_version": F.lit(parser_version), "policy_version": F.lit(policy.version)}).drop("__why", "error", "error_type")
    failures = n.where("__why is not null").select(F.col("source_url").alias("url"), F.left("__why", F.lit(2000)).alias("error"), F.coalesce("error_type", F.lit("ValidationError")).alias("error_type"), "content_sha256", F.lit(parser_version).alias("parser_version"), F.lit(policy.version).alias("policy_version"))
    return entries, failures


def page_links(pages: DataFrame, key: str = "dom_id") -> DataFrame:
    """key, pos, link: the distinct absolute links of each page in their order; is_entry tells entry pages."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(k, i, x) for k, u, h in zip(b[key], b["url"], b["html"], strict=True) if h for i, x in enumerate(dom.links(h, u or ""))]
            yield pd.DataFrame(rows, columns=[key, "pos", "link"])

    found = spread(pages.select(key, "url", "html")).mapInPandas(run, f"{key} {pages.schema[key].dataType.simpleString()}, pos int, link string")
    return found.withColumn("is_entry", is_entry_url(F.col("link")))


def page_meta(pages: DataFrame, key: str = "dom_id") -> DataFrame:
    """key, name, content of each page's metadata."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(k, n, c) for k, h in zip(b[key], b["html"], strict=True) if h for n, c in dom.meta(dom.parse(h)).items()]
            yield pd.DataFrame(rows, columns=[key, "name", "content"])

    return spread(pages.select(key, "html")).mapInPandas(run, f"{key} {pages.schema[key].dataType.simpleString()}, name string, content string")


def structure_tokens(pages: DataFrame, key: str = "dom_id", most_nodes: int | None = 30_000, most_depth: int | None = 60, most_classes: int | None = 3) -> DataFrame:
    """key, tokens, n_tokens, n_unique_tokens, n_nodes, max_depth, truncated, error of each page; truncated tells that the page has elements beyond
    the bounds (None sets no bound). An empty page or one that fails has an error and no tokens."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for k, h in zip(b[key], b["html"], strict=True):
                try:
                    if not h or not h.strip():
                        raise ValueError("empty page")
                    t, n, d, cut = dom.structure(h, most_nodes, most_depth, most_classes)
                    rows.append((k, t, sum(t.values()), len(t), n, d, cut, None))
                except Exception as e:  # noqa: BLE001
                    rows.append((k, None, None, None, None, None, None, str(e)))
            out = pd.DataFrame(rows, columns=[key, "tokens", "n_tokens", "n_unique_tokens", "n_nodes", "max_depth", "truncated", "error"])
            yield out.astype({c: "Int32" for c in ("n_tokens", "n_unique_tokens", "n_nodes", "max_depth")})

    return spread(pages.select(key, "html")).mapInPandas(run, f"{key} {pages.schema[key].dataType.simpleString()}, tokens map<string,int>, n_tokens int, n_unique_tokens int, n_nodes int, max_depth int, truncated boolean, error string")
