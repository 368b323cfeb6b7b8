"""URLs as column expressions: identity, parts, predicates, labels and repair. Nulls give null unless said otherwise."""

from __future__ import annotations

from functools import reduce
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from quillmesh.site import DEFAULT_SITE, SiteProfile


def url_id(url: Column) -> Column:
    return F.sha1(url)


def content_hash(html: Column) -> Column:
    return F.sha2(html, 256)


def byte_length(text: Column) -> Column:
    return F.octet_length(text)


def host(url: Column) -> Column:
    """Host with user part and port, as it stands in the URL; '' where there is none."""
    return F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)", 1)


def path(url: Column) -> Column:
    """Path without query and fragment; '' for a URL of only a host."""
    return F.regexp_extract(url, r"^(?:(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//[^/?#]*)?([^?#]*)", 1)


def segments(url: Column) -> Column:
    """The path's segments that aren't empty."""
    return F.filter(F.split(path(url), "/"), lambda s: s != "")


def strip_query(url: Column) -> Column:
    return F.regexp_extract(url, r"^([^?#]*)", 1)


def is_entry_url(url: Column, site: SiteProfile = DEFAULT_SITE) -> Column:
    """Whether a URL points at an entry: an allowed or no host, two segments or more, a known root first and neither a listing word nor a
    number last. A null URL isn't one."""
    s = segments(url)
    first, last = F.get(s, F.lit(0)), F.element_at(s, -1)
    ok = host(url).isin("", *site.hosts) & (F.size(s) >= 2)
    return F.coalesce(F.when(ok, first.isin(*site.entry_roots) & ~last.isin(*site.listing_words) & ~last.rlike(r"^\d+$")), F.lit(False))


def _first_prefix(text: Column, patterns: tuple[tuple[str, str], ...], default: Column) -> Column:
    return reduce(lambda rest, p: F.when(text.startswith(p[0]), F.lit(p[1])).otherwise(rest), reversed(patterns), default)


def namespace(url: Column, site: SiteProfile = DEFAULT_SITE) -> Column:
    """Label of the first pattern that the path, without slashes at its end, begins with; else null."""
    return _first_prefix(F.regexp_replace(path(url), "/+$", ""), site.patterns, F.lit(None).cast("string"))


def fallback_namespace(url: Column, site: SiteProfile = DEFAULT_SITE) -> Column:
    """As namespace(), by the other table, over the whole path; `unknown` where nothing fits, also for a null URL."""
    return _first_prefix(path(url), site.fallback_patterns, F.lit("unknown"))


def category(url: Column, site: SiteProfile = DEFAULT_SITE) -> Column:
    """Category by the path, a leading /sensitive left out; else `unknown`."""
    return _first_prefix(F.regexp_replace(path(url), "^/sensitive", ""), site.categories, F.lit("unknown"))


def repair(url: Column) -> Column:
    """A URL whose scheme is mistyped (`https;//`, `https//`) or follows other text, put right; null where nothing plausible is left."""
    s = F.trim(F.regexp_replace(url, r"^\s+|\s+$", ""))
    s = F.when(s.rlike(r"(?i)^https?\s*[;,]?\s*//"), F.concat(F.lower(F.regexp_extract(s, r"(?i)^(https?)", 1)), F.lit("://"), F.regexp_replace(s, r"(?i)^https?\s*[;,]?\s*//", ""))).otherwise(s)
    s = F.when(s.rlike(r"(?i)^https?://"), s).when(s.rlike(r"(?i)https?://"), F.regexp_extract(s, r"(?i)(https?://.*)$", 1)).otherwise(s)
    return F.when(s.rlike(r"(?i)^https?://[^\s<>\"']+$"), s)


def absolute(href: Column, site: SiteProfile = DEFAULT_SITE) -> Column:
    """A link that begins with / on the site's host, without its fragment; other links as they are; null for an empty one."""
    plain = F.regexp_extract(href, r"^([^#]*)", 1)
    return F.when(href.startswith("//"), F.concat(F.lit("https:"), plain)).when(href.startswith("/"), F.concat(F.lit(site.base_url), plain)).when(href != "", href)


@F.pandas_udf(StringType())
def joined(base: pd.Series, href: pd.Series) -> pd.Series:
    """Any link resolved against any base, by RFC 3986. Null where either is null or the link is no URL."""

    def one(b, h):
        try:
            return None if b is None or h is None else urljoin(b, h)
        except ValueError:
            return None

    return pd.Series([one(b, h) for b, h in zip(base, href, strict=True)])


def looks_like_page(html: Column, least_bytes: int = 2048) -> Column:
    """Long enough in UTF-8 and with a html tag near its beginning; a null page doesn't."""
    return F.coalesce((F.octet_length(html) >= least_bytes) & F.lower(F.left(html, F.lit(2048))).contains("<html"), F.lit(False))
