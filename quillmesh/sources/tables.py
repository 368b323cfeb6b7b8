"""Scans of the stored tables: pruned to what each stage needs, semi-joined to the urls it asks for."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def known_urls(urls: DataFrame) -> DataFrame:
    return urls.where("url is not null").select("url").distinct()


def content_hashes(doms: DataFrame, urls: DataFrame | None = None) -> DataFrame:
    """url, content_sha256 of the good pages that have a hash; the html isn't read."""
    good = doms.where("scrape_status = 'ok' and content_sha256 is not null").select("url", "content_sha256")
    return good if urls is None else good.join(urls.select("url"), "url", "left_semi")


def stored_pages(doms: DataFrame, urls: DataFrame | None = None) -> DataFrame:
    """url, html, content_sha256 of the good pages."""
    good = doms.where("scrape_status = 'ok' and html is not null").select("url", "html", "content_sha256")
    return good if urls is None else good.join(urls.select("url"), "url", "left_semi")


def pages_of(urls: DataFrame, doms: DataFrame, confirmed_only: bool = True, limit: int = 0) -> DataFrame:
    """url, namespace, html, content_sha256 of known urls with a good page; the first so many, 0 for all."""
    wanted = (urls.where("confirmed") if confirmed_only else urls).select("url", "namespace")
    out = wanted.join(stored_pages(doms), "url")
    return out.orderBy("url").limit(limit) if limit else out


def page_of(doms: DataFrame, url: str) -> str | None:
    """The html of one page, or None."""
    r = stored_pages(doms).where(F.col("url") == url).select("html").first()
    return r[0] if r else None


def feature_tokens(features: DataFrame, extractor_version: int) -> DataFrame:
    """url, tokens of one extractor version; rows without tokens are left out."""
    return features.where((F.col("extractor_version") == extractor_version) & F.col("tokens").isNotNull()).select("url", "tokens")
