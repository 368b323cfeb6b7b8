"""The queries of the general problems: times in many formats, and records that are new or changed."""

from __future__ import annotations

import uuid
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmesh.functions.timestamps import CANONICAL, add_utc_micros, known_zones
from quillmesh.operators.incremental import Ledger, changed_states, good_fetches, stages_of
from quillmesh.session import Workspace, shared_folder


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def with_zone(df: DataFrame, workers: DataFrame) -> DataFrame:
    """df with worker_zone. A worker with several rows keeps the zone that is greatest by name; a row without a worker gets null."""
    zones = workers.where("worker_id is not null").groupBy("worker_id").agg(F.max("zone_name").alias("worker_zone"))
    return df.join(zones, "worker_id", "left")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The time texts that aren't in the canonical form already, each with its instant."""
    zones, workers = known_zones(spark), read(spark, sf_dir, "workers")
    urls, doms = read(spark, sf_dir, "urls"), read(spark, sf_dir, "doms")
    text = lambda df, table, key, field, zone: df.select(F.lit(table).alias("src_table"), F.col(key).alias("row_id"), F.lit(field).alias("field_name"), F.col(field).alias("text"), zone.alias("worker_id"), F.lit(field == "lastmod").alias("is_utc"))
    texts = text(urls, "urls", "url_id", "lastmod", F.lit(None).cast("int")).unionByName(text(urls, "urls", "url_id", "last_scraped", F.col("worker_id"))).unionByName(text(doms, "doms", "dom_id", "fetched_at", F.col("worker_id")))
    texts = with_zone(texts.where(F.col("text").isNotNull() & ~F.col("text").rlike(CANONICAL)), workers)
    found = add_utc_micros(texts, "utc_micros", F.col("text"), F.when(F.col("is_utc"), F.lit("UTC")).otherwise(F.col("worker_zone")), zones)
    return found.where("utc_micros is not null").select("src_table", "row_id", "field_name", "utc_micros")


#: The first of two runs sees what was visible before this time, while a transaction of the month before is open.
FIRST_RUN, OLDEST_OPEN = datetime(2026, 1, 1, tzinfo=timezone.utc), datetime(2025, 12, 2, tzinfo=timezone.utc)


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The urls to fetch and to parse, after two runs through the ledger. The first decides on what was there before FIRST_RUN and commits the
    states it has seen; the second rereads from the oldest transaction that was open then, drops by the ledger what it has seen in this
    state already, and decides on the rest. A url that the second doesn't decide on keeps what the first has decided."""
    zones, workers = known_zones(spark), read(spark, sf_dir, "workers")
    urls = add_utc_micros(read(spark, sf_dir, "urls").select("url", "confirmed", "lastmod", "discovered_at"), "lastmod_us", F.col("lastmod"), F.lit("UTC"), zones)
    fetches = with_zone(good_fetches(read(spark, sf_dir, "doms")), workers)
    fetches = add_utc_micros(fetches, "fetched_us", F.col("fetched_at"), F.col("worker_zone"), zones).select("dom_id", "url", "version", "fetched_us", "received_at")
    entries = read(spark, sf_dir, "entries").select("url", "dom_content_sha256", "run_id", "parsed_at", "entry_id")
    runs = read(spark, sf_dir, "run_summaries").select("run_id", "state", "created_at")
    work = Workspace(spark, "stages")
    urls, fetches = work.write(urls.drop("lastmod"), "urls"), work.write(fetches, "fetches")
    ledger = Ledger(spark, f"{shared_folder(spark)}/ledger-{uuid.uuid4().hex[:12]}", "url string, version string")
    before = lambda df, at: df.where(F.col(at) < F.lit(FIRST_RUN))
    first = work.write(changed_states(ledger, before(urls, "discovered_at"), before(fetches, "received_at"), before(entries, "parsed_at"), before(runs, "created_at")), "first")
    ledger.commit("first", first.select("url", "version"), FIRST_RUN, OLDEST_OPEN)
    second = work.write(changed_states(ledger, urls, fetches, entries, runs), "second")
    return stages_of(first.join(second.select("url"), "url", "left_anti").unionByName(second))


def p3_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs over the good fetches, each page version processed once: the first sees what was received before the middle and commits while a
    transaction of the month before is open; the second rereads from there on."""
    cut = datetime(2026, 1, 1, tzinfo=timezone.utc)
    fetches = good_fetches(read(spark, sf_dir, "doms"))
    ledger = Ledger(spark, f"{shared_folder(spark)}/ledger-{uuid.uuid4().hex[:12]}", "url string, version string")
    first = ledger.pending(fetches.where(F.col("received_at") < F.lit(cut)), F.col("received_at"), ["url"], "version").select("url", "version").distinct()
    ledger.commit("first", first, cut, cut - timedelta(days=30))
    second = ledger.pending(fetches, F.col("received_at"), ["url"], "version").select("url", "version").distinct()
    return ledger.processed().withColumn("run", F.lit("first")).unionByName(second.withColumn("run", F.lit("second")))


# An own way to the same instants: the zone's offsets two days before and after a local time, whichever fits, the first where both or neither do.
_TIMES = r"""
w as (select worker_id, max(zone_name) as zone from workers where worker_id is not null group by worker_id),
raw as (select 'urls' as src_table, url_id as row_id, 'lastmod' as field_name, lastmod as txt, 'UTC' as zone from urls
  union all select 'urls', url_id, 'last_scraped', last_scraped, zone from urls left join w using (worker_id)
  union all select 'doms', dom_id, 'fetched_at', fetched_at, zone from doms left join w using (worker_id)),
t as (select *, regexp_replace(txt, '^\s+|\s+$', '', 'g') as s from raw where txt is not null),
f as (select *,
  regexp_extract(s, '^(\d{4})[-/](\d{2})[-/](\d{2})(?:[T ](\d{2}):(\d{2})(?::(\d{2})(?:[.,](\d+))?)?)? ?(\[[A-Za-z_/]+\]|[A-Z]{1,4}|[+-]\d{2}:?\d{2})?$', ['y', 'mo', 'd', 'h', 'mi', 'se', 'fr', 'z']) as a,
  regexp_extract(s, '^(\d{4})(\d{2})(\d{2})T(\d{2})(\d{2})(\d{2})(Z)$', ['y', 'mo', 'd', 'h', 'mi', 'se', 'z']) as b,
  regexp_extract(s, '^(?:[A-Z][a-z]{2}, )?(\d{1,2}) ([A-Z][a-z]{2}) (\d{4}) (\d{2}):(\d{2}):(\d{2}) ?([A-Z]{3}|[+-]\d{4})?$', ['d', 'mo', 'y', 'h', 'mi', 'se', 'z']) as c,
  regexp_extract(s, '^([A-Z][a-z]{2}) (\d{1,2}), (\d{4}) (\d{1,2}):(\d{2}) ([AP]M)$', ['mo', 'd', 'y', 'h', 'mi', 'half']) as e,
  regexp_extract(s, '^(\d{4})-(\d{2})$', ['y', 'mo']) as m from t),
g as (select src_table, row_id, field_name, txt, zone, s, case when a.y <> '' then a.y || '-' || a.mo || '-' || a.d || ' ' || coalesce(nullif(a.h, ''), '00') || ':' || coalesce(nullif(a.mi, ''), '00') || ':' || coalesce(nullif(a.se, ''), '00')
  when b.y <> '' then b.y || '-' || b.mo || '-' || b.d || ' ' || b.h || ':' || b.mi || ':' || b.se when m.y <> '' then m.y || '-' || m.mo || '-01 00:00:00'
  when c.y <> '' then c.y || '-' || lpad(((position(c.mo in 'JanFebMarAprMayJunJulAugSepOctNovDec') + 2) // 3)::varchar, 2, '0') || '-' || lpad(c.d, 2, '0') || ' ' || c.h || ':' || c.mi || ':' || c.se
  when e.y <> '' then e.y || '-' || lpad(((position(e.mo in 'JanFebMarAprMayJunJulAugSepOctNovDec') + 2) // 3)::varchar, 2, '0') || '-' || lpad(e.d, 2, '0') || ' ' || lpad((coalesce(try_cast(e.h as int), 0) % 12 + case when e.half = 'PM' then 12 else 0 end)::varchar, 2, '0') || ':' || e.mi || ':00' end as wall_text,
  coalesce(left(nullif(a.fr, '') || '000000', 6)::bigint, 0) as fr, coalesce(nullif(a.z, ''), nullif(b.z, ''), nullif(c.z, '')) as z from f),
h as (select *, epoch_us(try_cast(wall_text as timestamp)) as wall, case when z is null then zone when starts_with(z, '[') then trim(z, '[]') end as region,
  case when regexp_matches(z, '^[+-]') then (case when z[1] = '-' then -1 else 1 end) * (try_cast(z[2:3] as int) * 60 + try_cast(right(z, 2) as int))
  else case z when 'Z' then 0 when 'UTC' then 0 when 'GMT' then 0 when 'CET' then 60 when 'CEST' then 120 when 'BST' then 60 when 'IST' then 330 when 'EST' then -300 when 'EDT' then -240 when 'CST' then -360 when 'CDT' then -300 when 'AEST' then 600 when 'AEDT' then 660 when 'BRT' then -180 end end as off from g),
o as (select *, epoch_us(timezone(region, make_timestamptz(wall - 172800000000))) - (wall - 172800000000) as o1, epoch_us(timezone(region, make_timestamptz(wall + 172800000000))) - (wall + 172800000000) as o2 from h),
i as (select src_table, row_id, field_name, txt, case when regexp_matches(s, '^\d+(\.\d+)?$') then (case when try_cast(s as decimal(38, 6)) < 100000000000 then floor(try_cast(s as decimal(38, 6)) * 1000000) when try_cast(s as decimal(38, 6)) < 100000000000000 then floor(try_cast(s as decimal(38, 6)) * 1000) when try_cast(s as decimal(38, 6)) < 100000000000000000 then floor(try_cast(s as decimal(38, 6))) else floor(try_cast(s as decimal(38, 6)) / 1000) end)::bigint
  when wall is null then null when off is not null then wall - off::bigint * 60000000 + fr when region is null then null
  when epoch_us(timezone(region, make_timestamptz(wall - o1))) = wall then wall - o1 + fr when epoch_us(timezone(region, make_timestamptz(wall - o2))) = wall then wall - o2 + fr else wall - o1 + fr end as us from o)
"""
_P4 = "with " + _TIMES.strip() + r" select src_table, row_id, field_name, us as utc_micros from i where us is not null and not regexp_matches(txt, '^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{6})?\+00:00$')"
_P3 = "with " + _TIMES.strip() + r""",
d as (select dom_id, url, lower(coalesce(content_sha256, sha256(html))) as sha, us from doms join (select row_id, us from i where field_name = 'fetched_at') k on k.row_id = dom_id where scrape_status = 'ok' and html is not null and us is not null and url is not null qualify row_number() over (partition by url order by us desc, dom_id desc) = 1),
r as (select run_id from (select run_id, state from run_summaries where run_id is not null qualify row_number() over (partition by run_id order by created_at desc, state desc) = 1) where state = 'success'),
n as (select url, lower(dom_content_sha256) as sha from entries join r using (run_id) where url is not null qualify row_number() over (partition by url order by parsed_at desc, entry_id desc) = 1),
u as (select url, bool_or(confirmed) as confirmed, max(us) as lastmod from urls left join (select row_id, us from i where field_name = 'lastmod') k on k.row_id = url_id where url is not null group by url)
select url, 'parse' as stage from d where not exists (select 1 from n where n.url = d.url and n.sha is not distinct from d.sha)
union all select u.url, 'fetch' from u left join d using (url) where confirmed and (d.us is null or lastmod > d.us)"""

QUERIES = {"p3_found": p3_found, "p3_runs": p3_runs, "p4_found": p4_found}
ORACLES = {
    "p3_found": _P3,
    "p4_found": _P4,
    "p3_runs": "select url, lower(coalesce(content_sha256, sha256(html))) as version, case when coalesce(min(received_at) < timestamptz '2026-01-01 00:00:00+00', false) then 'first' else 'second' end as run from doms where scrape_status = 'ok' and html is not null and url is not null group by 1, 2",
}
