"""Discovery: change detection against a known index, sitemap trees, namespace patterns from a corpus of URLs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmesh.functions.urls import namespace, segments
from quillmesh.session import Workspace
from quillmesh.site import DEFAULT_SITE, SiteProfile


def changed_entries(found: DataFrame, known: DataFrame, key: str = "url") -> DataFrame:
    """key, lastmod, confirmed, change of the sitemap entries whose lastmod differs from the known one (null equals null): updated if the key
    is known, else added. An entry with a lastmod is confirmed, one without keeps what is known. found and known: one row for each key."""
    k = known.select(F.col(key).alias("__k"), F.col("lastmod").alias("__lastmod"), F.col("confirmed").alias("__confirmed"))
    j = found.select(key, "lastmod").join(k, F.col(key) == F.col("__k"), "left")
    new = F.col("__k").isNull()
    return j.where(new | ~F.col("lastmod").eqNullSafe(F.col("__lastmod"))).select(
        key, "lastmod", F.when(F.col("lastmod").isNotNull(), True).otherwise(F.coalesce("__confirmed", F.lit(False))).alias("confirmed"), F.when(new, "added").otherwise("updated").alias("change")
    )


def records(urls: DataFrame, confirmed, lastmod, site: SiteProfile = DEFAULT_SITE, key: str = "url") -> DataFrame:
    """Discovery records: key, namespace, confirmed, lastmod (null unless confirmed)."""
    return urls.select(key, namespace(F.col(key), site).alias("namespace"), confirmed.alias("confirmed"), F.when(confirmed, lastmod).alias("lastmod"))


def sitemap_tree(roots: DataFrame, children: DataFrame) -> DataFrame:
    """loc of all sitemaps reachable from the roots (loc), however deep; children: parent, child. One join for each level, each sitemap
    once, so a tree with loops ends."""
    work = Workspace(roots.sparkSession, "sitemaps")
    level = work.write(roots.select("loc").where("loc is not null").distinct(), "level0")
    seen, n = level, 0
    while True:
        n += 1
        step = children.where("child is not null").join(level.withColumnRenamed("loc", "parent"), "parent", "left_semi").select(F.col("child").alias("loc")).distinct()
        level = work.write(step.join(seen, "loc", "left_anti"), f"level{n}")
        if not level.head(1):
            break
        seen = work.write(seen.unionByName(level), f"seen{n}")
    return seen


def prefixes(urls: DataFrame, key: str = "url", least: int = 2) -> DataFrame:
    """prefix, label, n: path prefixes - all segments but the last - that at least so many URLs have; longer ones stand first."""
    s = segments(F.col(key))
    named = urls.where(F.size(s) >= 2).select(F.concat(F.lit("/"), F.array_join(F.slice(s, 1, F.size(s) - 1), "/"), F.lit("/")).alias("prefix"))
    out = named.groupBy("prefix").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)
    return out.select("prefix", F.expr("substring(prefix, 2, length(prefix) - 2)").alias("label"), "n")


def infer_site(urls: DataFrame, site: SiteProfile = DEFAULT_SITE, key: str = "url") -> SiteProfile:
    """The profile with the patterns of a corpus, longest first, and the listing pages seen in it. An empty corpus leaves the profile as it
    is. The patterns go to the driver: a site has as many as it has sections."""
    found = sorted(((r["prefix"], r["label"]) for r in prefixes(urls, key).collect()), key=lambda p: (-len(p[0]), p[0]))
    if not found:
        return site
    if site.patterns and not any(p == "/memes/" for p, _ in found):
        found.append(("/memes/", "memes"))
    s = segments(F.col(key))
    first, second = F.get(s, F.lit(0)), F.get(s, F.lit(1))
    listed = urls.where((F.size(s) == 2) & first.isin(*site.entry_roots) & second.isin(*site.listing_words)).select(F.concat(F.lit("/"), first, F.lit("/"), second).alias("p")).distinct()
    own = {p for p, _ in site.listings}
    return SiteProfile(**(site.__dict__ | {"patterns": tuple(found), "listings": (*site.listings, *((r["p"], False) for r in listed.orderBy("p").collect() if r["p"] not in own))}))
