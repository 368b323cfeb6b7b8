"""The queries of the training-data operators over the test tables, and the SQL that checks them."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmesh.llm import boilerplate, clusters, contamination, cooccurrence, mixing, pii, residue, tfidf
from quillmesh.session import Workspace, shared_folder


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _pair_table(spark: SparkSession) -> cooccurrence.PairTable:
    return cooccurrence.PairTable(spark, f"{shared_folder(spark)}/pairs-{uuid.uuid4().hex[:12]}", buckets=4)


def _above_chance(table: cooccurrence.PairTable) -> DataFrame:
    return table.association(least_count=5).where(F.col("n_ab") * F.col("n") >= 3 * F.col("n_a") * F.col("n_b"))


def _in_batches(spark: SparkSession, sf_dir: str, batches: int, order: tuple[int, ...] = ()) -> cooccurrence.PairTable:
    """A pair table that has taken in the entries in batches of equal spans of time, in their order or another. The first also brings
    those without a time."""
    entries, table = read(spark, sf_dir, "entries"), _pair_table(spark)
    least, most = entries.agg(F.min(F.unix_micros("parsed_at")), F.max(F.unix_micros("parsed_at"))).first()
    at = F.coalesce(F.unix_micros("parsed_at"), F.lit(least if least is not None else 0))
    batch = F.least(F.floor((at - F.lit(least or 0)) * batches / F.lit(max(1, (most or 0) - (least or 0)))), F.lit(batches - 1))
    for n in order or range(batches):
        table.update(str(n), cooccurrence.current_baskets(entries.where(batch == n)))
    return table


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of items far above chance, from a pair table that has taken in the entries in two batches: what was parsed in the first half of the
    time, then what has changed since, as signed deltas."""
    return _above_chance(_in_batches(spark, sf_dir, 2)).select("item_a", "item_b")


def p1_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same pairs with their counts, from three batches of which the second comes last: where the third has brought a later form of a
    basket, the second's is late."""
    return _above_chance(_in_batches(spark, sf_dir, 3, (0, 2, 1))).select("item_a", "item_b", "n_ab", "n_a", "n_b", "n")


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The distinct blocks of each page's main body."""
    bodies = boilerplate.main_bodies(read(spark, sf_dir, "doms"))
    keys = F.array_distinct(F.transform("blocks", lambda b: F.substring(F.md5(b.cast("binary")), 1, 16)))
    return bodies.select("dom_id", F.explode(keys).alias("block_key"))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages that show residue."""
    return residue.residue_pages(read(spark, sf_dir, "doms")).select("dom_id")


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The members of each group of at least five pages, but for the one that names the group."""
    members, _ = clusters.cluster(read(spark, sf_dir, "dom_features"))
    return members.where("size >= 5 and feature_id <> root").select(F.col("root").alias("root_id"), "feature_id")


def p5_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each group with its size and its three most typical pages."""
    _, classes = clusters.cluster(read(spark, sf_dir, "dom_features"))
    return clusters.typical(classes, Workspace(spark, "typical"))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three tokens of each row with the highest unsmoothed score."""
    rows = tfidf.postings(read(spark, sf_dir, "dom_features"))
    scored = tfidf.score(rows, "feature_id", smooth=False, normalise=False, min_df=2, below_all=True, digits=6)
    return tfidf.top_terms(scored, "feature_id", 3).select("feature_id", "token")


def p7_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All tokens of each row with the smoothed score, divided by the row's length."""
    rows = tfidf.postings(read(spark, sf_dir, "dom_features"))
    return tfidf.score(rows, "feature_id", digits=6).select("feature_id", "token", "score")


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination.leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "eval_items")).select("doc_id", "item_id")


def p9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents of the mix in its order, at the largest size at which no source runs out."""
    return mixing.mix(read(spark, sf_dir, "documents"), read(spark, sf_dir, "mix_targets"))[0]


def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each source contributes to the mix."""
    return mixing.mix(read(spark, sf_dir, "documents"), read(spark, sf_dir, "mix_targets"))[1]


def p9_full_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each source contributes where the budget is all that the sources have: small ones are repeated up to their cap and fall behind."""
    documents, targets = read(spark, sf_dir, "documents"), read(spark, sf_dir, "mix_targets")
    sizes = documents.select(mixing.normal_source(F.col("source")).alias("source"), F.length("text").alias("n")).groupBy("source").agg(F.sum("n").alias("n"))
    named = targets.select(mixing.normal_source(F.col("source")).alias("source")).distinct()
    total = sizes.join(F.broadcast(named), "source").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    # About four characters of a text make a token.
    return mixing.mix(documents, targets, total_tokens=int(total // 4))[1]


def p9_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each target whether its source has texts, keeps its cap of repetitions, and reaches its share among the sources that have texts."""
    documents, targets = read(spark, sf_dir, "documents"), read(spark, sf_dir, "mix_targets")
    _, shares = mixing.mix(documents, targets)
    caps = targets.select(mixing.normal_source(F.col("source")).alias("source"), "max_repeats").groupBy("source").agg(F.max("max_repeats").alias("cap"))
    live = shares.where("available_tokens > 0").agg(F.sum("target_share")).first()[0] or 1.0
    near = F.abs(F.col("actual_share") - F.col("target_share") / F.lit(live)) < 0.02
    rows = shares.join(F.broadcast(caps), "source")
    return rows.select("source", (F.col("available_tokens") > 0).alias("has_texts"), (F.col("copies") <= F.col("cap")).alias("within_cap"), F.when(F.col("available_tokens") > 0, near).otherwise(F.col("actual_share") == 0).alias("reached"))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The distinct personal data of each document."""
    found = pii.find(read(spark, sf_dir, "documents"))
    return found.select("doc_id", F.explode("spans").alias("s")).select("doc_id", "s.kind", "s.found_text").distinct()


def p10_redacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document with placeholders in place of personal data."""
    return pii.find(read(spark, sf_dir, "documents")).select("doc_id", F.col("redacted").alias("text"), F.size("spans").alias("n_found"))


_P1 = r"""
with ranked as (
  select url, tags, entry_type, row_number() over (partition by url order by parsed_at desc nulls last, entry_id desc) as r
  from entries where url is not null),
cur as (select url, tags, entry_type from ranked where r = 1),
t as (select url, trim(regexp_replace(regexp_replace(lower(x), '^[\s_]*#+', ''), '[\s_]+', ' ', 'g')) as s from (select url, unnest(tags) as x from cur)),
y as (select url, list_filter(list_transform(string_split(lower(x), '/'), lambda v: trim(v)), lambda v: v <> '') as p from (select url, unnest(entry_type) as x from cur)),
i as (select distinct url, 'tag:' || s as item from t where s <> '' union select distinct url, 'type:' || p[-1] from y where len(p) > 0),
c as (select item, count(*) as n from i group by item),
p as (select a.item as item_a, b.item as item_b, count(*) as n_ab from i a join i b on a.url = b.url and a.item < b.item group by all having count(*) >= 5),
q as (select item_a, item_b, n_ab, a.n as n_a, b.n as n_b, (select count(*) from cur) as n from p join c a on a.item = item_a join c b on b.item = item_b)
"""
_P7 = """
with o as (select feature_id, unnest(map_entries(tokens)) as e from dom_features where feature_id is not null),
p as (select feature_id, e.key as token, e.value as cnt from o where e.value > 0),
n as (select count(distinct feature_id)::double as n from p),
d as (select token, count(*) as df from p group by token)
"""

QUERIES = {
    "p1_found": p1_found, "p1_incremental": p1_incremental, "p2_found": p2_found, "p5_found": p5_found, "p5_groups": p5_groups, "p6_found": p6_found, "p7_found": p7_found, "p7_weights": p7_weights, "p8_found": p8_found, "p9_mix": p9_mix, "p9_shares": p9_shares, "p9_full_budget": p9_full_budget, "p9_bounds": p9_bounds, "p10_found": p10_found, "p10_redacted": p10_redacted,
}
ORACLES = {
    "p1_found": _P1 + "select item_a, item_b from q where n_ab * n >= 3 * n_a * n_b",
    "p1_incremental": _P1 + "select item_a, item_b, n_ab, n_a, n_b, n from q where n_ab * n >= 3 * n_a * n_b",
    "p5_found": """
with s as (select feature_id, list_filter(map_keys(tokens), lambda k: tokens[k] > 0) as ts from dom_features where tokens is not null and feature_id is not null),
t as (select feature_id, len(ts) as n, unnest(ts) as tok from s where len(ts) > 0),
l as (select a.feature_id as x, b.feature_id as y from t a join t b using (tok) group by a.feature_id, b.feature_id, a.n, b.n having 2 * count(*) >= a.n + b.n - count(*)),
g as (select x as feature_id, min(y) as root_id, count(*) as size from l group by x)
select root_id, feature_id from g where size >= 5 and root_id <> feature_id""",
    "p7_found": _P7 + """,
s as (select feature_id, token, round(cnt * ln(n / df), 6) as score from p join d using (token), n where df >= 2 and df < n)
select feature_id, token from (select *, row_number() over (partition by feature_id order by score desc, token) as r from s) where r <= 3""",
    "p7_weights": _P7 + """,
s as (select feature_id, token, cnt * (ln((1 + n) / (1 + df)) + 1) as w from p join d using (token), n)
select feature_id, token, round(w / sqrt(sum(w * w) over (partition by feature_id)), 6) as score from s""",
    "p9_bounds": r"""
with t as (select lower(regexp_replace(source, '^\s+|\s+$', '', 'g')) as source from mix_targets where source is not null and target_share > 0 group by 1),
d as (select lower(regexp_replace(source, '^\s+|\s+$', '', 'g')) as source, count(*) as n from documents where text <> '' group by 1)
select t.source, coalesce(d.n, 0) > 0 as has_texts, true as within_cap, true as reached from t left join d using (source)""",
    "p8_found": r"""
with w as (select doc_id, list_filter(list_transform(regexp_split_to_array(lower(text), '\s+'), lambda x: regexp_replace(x, '[^\p{L}\p{N}]', '', 'g')), lambda x: x <> '') as ws from documents where text is not null),
v as (select item_id, list_filter(list_transform(regexp_split_to_array(lower(passage), '\s+'), lambda x: regexp_replace(x, '[^\p{L}\p{N}]', '', 'g')), lambda x: x <> '') as ws from eval_items),
dw as (select distinct doc_id, array_to_string(ws[i:i + 7], ' ') as s from (select doc_id, ws, unnest(range(1, len(ws) - 6)) as i from w)),
iw as (select item_id, i, array_to_string(ws[i:i + 7], ' ') as s from (select item_id, ws, unnest(range(1, len(ws) - 6)) as i from v)),
k as (select distinct doc_id, item_id, unnest(range(i, i + 8)) as pos from dw join iw using (s)),
c as (select doc_id, item_id, count(*) as n from k group by all)
select doc_id, item_id from c join v using (item_id) where 2 * n >= len(ws)""",
}
