"""Selections of pending work: anti-joins on hashes and version stamps, buckets of retries, namespace filters, chunks."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillmesh.session import Workspace

NEVER, RETRY, STALE = 0, 1, 2


def namespace_names(raw: str | Iterable[str] | None) -> list[str] | None:
    """A namespace parameter as a list of names: text with commas, a list, quotes around names; None for nothing."""
    items = raw.split(",") if isinstance(raw, str) else list(raw or [])
    names = [n for n in (str(i).strip().strip("'\"").strip() for i in items) if n]
    return names or None


def in_namespaces(df: DataFrame, names: list[str] | None, column: str = "namespace", check: bool = False) -> DataFrame:
    """Rows in the namespaces or below them; `unknown` stands for rows without one. check: a name that fits no row is an error."""
    if not names:
        return df
    c = F.col(column)
    fits = [c.isNull() if n == "unknown" else (c == n) | c.startswith(n + "/") for n in names]
    if check:
        n, *found = df.agg(F.count(F.lit(1)), *(F.count_if(F.coalesce(f, F.lit(False))) for f in fits)).first()
        if n and not all(found):
            counts = ", ".join(f"{name}: {k}" for name, k in zip(names, found, strict=True))
            raise ValueError(f"the namespace filter fits no row for some names; of {n} rows {counts}")
        if not n:
            raise ValueError(f"the namespace filter {names} has no rows to choose from")
    out = fits[0]
    for f in fits[1:]:
        out = out | f
    return df.where(F.coalesce(out, F.lit(False)))


def is_stale(fetched: Column, lastmod: Column, cutoff: Column | None = None) -> Column:
    """Never fetched, fetched before the cutoff, or changed since. A null lastmod doesn't make a page stale."""
    old = fetched.isNull() | F.coalesce(lastmod > fetched, F.lit(False))
    return old if cutoff is None else old | F.coalesce(fetched < cutoff, F.lit(False))


def scrape_buckets(urls: DataFrame, doms: DataFrame, cutoff: Column | None = None, most_attempts: int = 3, key: str = "url") -> DataFrame:
    """key, bucket of the urls to fetch: NEVER for those without a stored outcome, RETRY for failed ones with attempts left whose error
    isn't permanent, STALE for good ones that are out of date. urls: key, lastmod; doms: key, scrape_status, fetched, attempts,
    last_error_kind - both with one row for each key."""
    j = urls.select(key, "lastmod").join(doms.select(key, "scrape_status", "fetched", "attempts", "last_error_kind"), key, "left")
    retry = (F.col("scrape_status") == "failed") & (F.coalesce("attempts", F.lit(0)) < most_attempts) & F.coalesce(F.col("last_error_kind") != "permanent", F.lit(True))
    stale = (F.col("scrape_status") == "ok") & is_stale(F.col("fetched"), F.col("lastmod"), cutoff)
    bucket = F.when(F.col("scrape_status").isNull(), NEVER).when(retry, RETRY).when(stale, STALE)
    return j.select(key, bucket.alias("bucket")).where("bucket is not null")


def first_pending(buckets: DataFrame, limit: int = 0, key: str = "url") -> DataFrame:
    """In the order of buckets, then keys; the first so many, 0 for all."""
    ordered = buckets.orderBy("bucket", key)
    return ordered.limit(limit) if limit else ordered


def pending_versions(candidates: DataFrame, done: list[DataFrame], keys: list[str]) -> DataFrame:
    """Candidates that no done table has with equal values in all keys, nulls equal to nulls: entries and dead letters that bear the same
    hash, parser and policy, features of the same hash and extractor."""
    out = candidates
    for d in done:
        b = d.select(*(F.col(f"`{k}`").alias(f"__{k}") for k in keys)).distinct()
        on = [F.col(f"`{k}`").eqNullSafe(F.col(f"__{k}")) for k in keys]
        out = out.join(b, on, "left_anti")
    return out


def without_done(urls: DataFrame, doms: DataFrame, key: str = "url") -> DataFrame:
    """urls that have no ok page."""
    return urls.join(doms.where("scrape_status = 'ok'").select(key).distinct(), key, "left_anti")


def with_namespace(rows: DataFrame, urls: DataFrame, fallback: Column, key: str = "url") -> DataFrame:
    """rows with the namespace that is stored for their key, else the one inferred. Of several stored ones the greatest counts."""
    names = urls.where(f"`{key}` is not null").groupBy(key).agg(F.max("namespace").alias("__ns"))
    return rows.join(names, key, "left").withColumn("namespace", F.coalesce(F.nullif(F.col("__ns"), F.lit("")), fallback)).drop("__ns")


def numbered(rows: DataFrame, order: list[str], name: str, parts: int = 64) -> DataFrame:
    """rows with their number (from 0) in the given order: the place within a range plus the sizes of the ranges before it, so the table
    isn't gathered in one task. The ranged rows are written first: ranges come from a sample and could fall otherwise when computed again."""
    ranged = Workspace(rows.sparkSession, "numbered").write(rows.repartitionByRange(parts, *order).withColumn("__p", F.spark_partition_id()), "ranged")
    sizes = ranged.groupBy("__p").agg(F.count(F.lit(1)).alias("__n"))
    # parts rows at most
    before = sizes.select("__p", F.coalesce(F.sum("__n").over(Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"))
    at = F.row_number().over(Window.partitionBy("__p").orderBy(*order))
    return ranged.withColumn("__at", at).join(F.broadcast(before), "__p").withColumn(name, F.col("__before") + F.col("__at") - 1).drop("__p", "__at", "__before")


def chunks(rows: DataFrame, size: int, order: list[str], parts: int = 64) -> DataFrame:
    """rows with chunk (from 0), so many rows in each, in the given order."""
    return numbered(rows, order, "__row", parts).withColumn("chunk", F.floor(F.col("__row") / size)).drop("__row")
