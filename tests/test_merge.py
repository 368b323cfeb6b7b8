from datetime import datetime

import pytest
from pyspark.sql import functions as F

from quillmesh.operators import merge, select
from quillmesh.operators.frequency import frequencies, join_frequencies
from quillmesh.session import Workspace

URLS = "url string, confirmed boolean, namespace string, lastmod string, last_scraped string"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_discovery_merge_rules(spark):
    known = spark.createDataFrame([("a", True, "memes", "2026-01-01", "s"), ("b", False, None, None, None)], URLS)
    batch = spark.createDataFrame([("a", False, None, None, "other", 1), ("b", False, "x", "2026-02-02", None, 1), ("b", True, None, "2026-03-03", None, 2), ("c", False, "y", "2026-01-01", None, 1), (None, True, "z", None, None, 1)], URLS + ", seq int")
    got = merge.merge_discovery(known, batch, ["seq"])
    assert rows(got) == [("a", True, "memes", "2026-01-01", "s", "updated"), ("b", True, None, "2026-03-03", None, "updated"), ("c", False, "y", None, None, "added")]
    again = merge.merge_discovery(got.drop("__outcome"), batch, ["seq"])
    assert rows(again.drop("__outcome")) == rows(got.drop("__outcome"))


def test_merge_update_only_and_extra_columns(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2)], "k string, n int")
    new = spark.createDataFrame([("a", 5, "x"), ("c", 7, "y")], "k string, n int, more string")
    assert rows(merge.keyed_merge(old, new, "k", {"n": merge.added}, insert=False)) == [("a", 6, "x", "updated"), ("b", 2, None, "kept")]
    assert rows(merge.keyed_merge(old.limit(0), new, "k", {})) == [("a", 5, "x", "added"), ("c", 7, "y", "added")]


def test_versioned_table(spark, tmp_path):
    table = merge.VersionedTable(spark, str(tmp_path / "t"))
    with pytest.raises(FileNotFoundError):
        table.read()
    one = spark.createDataFrame([("a", 1)], "k string, n int")
    assert table.merge(one, "k", {"n": merge.added}) == {"added": 1, "updated": 0}
    assert table.merge(spark.createDataFrame([("a", 2), ("b", 1)], "k string, n int"), "k", {"n": merge.added}) == {"added": 1, "updated": 1}
    assert rows(table.read()) == [("a", 3), ("b", 1)]
    # Data without a version file, as a failed merge leaves it, doesn't count.
    one.withColumn("bucket", F.lit(0)).write.partitionBy("bucket").parquet(str(tmp_path / "t/data/left"))
    assert rows(table.read()) == [("a", 3), ("b", 1)]
    # A column that only the batch has; keys of other buckets stay where they are.
    held = table._manifest(table.version())["data"]
    assert table.merge(spark.createDataFrame([("c", 1, "x"), (None, 9, "y")], "k string, n int, more string"), "k", {"n": merge.added}) == {"added": 1, "updated": 0}
    assert rows(table.read()) == [("a", 3, None), ("b", 1, None), ("c", 1, "x")]
    now = table._manifest(table.version())["data"]
    assert sum(held.get(b) != d for b, d in now.items()) == 1
    # Of two writers of one version one fails.
    v = table.version()
    with pytest.raises(RuntimeError, match="another writer"):
        table._commit(v, table._manifest(v))
    # An update-only merge, and more buckets as the table grows.
    table.BYTES = 200
    assert table.merge(spark.createDataFrame([("c", 5), ("q", 1)], "k string, n int"), "k", {}, insert=False) == {"added": 0, "updated": 1}
    assert table._manifest(table.version())["buckets"] > 4 and rows(table.read()) == [("a", 3, None), ("b", 1, None), ("c", 5, "x")]
    table.write(table.read().limit(0))
    assert table.read().count() == 0


def test_batches_of_a_stream_count_once(spark, tmp_path):
    """Also on a table that already has versions of its own and of other streams."""
    table = merge.VersionedTable(spark, str(tmp_path / "t"))
    row = lambda n: spark.createDataFrame([("a", n)], "k string, n int")
    for source, n, want in ((None, 1, 1), (("x", 0), 2, 3), (("y", 0), 3, 6), (("x", 0), 2, 6), (("x", 1), 1, 7), (("y", 0), 3, 7), (None, 1, 8)):
        table.merge(row(n), "k", {"n": merge.added}, source=source)
        assert table.read().first().n == want
    assert table.applied("x") == 1 and table.applied("z") == -1


LOG = "url string, seq int, ok boolean, payload string, error string, error_kind string, attempts_used int, at timestamp"
T = datetime(2026, 1, 1)


@pytest.mark.parametrize(
    ("outcomes", "status", "payload", "error", "tallies"),
    [
        ([(1, True, "p1", None), (2, False, None, "e")], "ok", "p1", "e", {"ok": 1, "kept_ok": 1}),
        ([(1, False, None, "e"), (2, True, "p2", None)], "ok", "p2", None, {"failed": 1, "ok": 1}),
        ([(1, True, None, None)], "failed", None, None, {"failed": 1}),
        ([(1, True, "", "thin")], "failed", None, "thin", {"failed": 1}),
    ],
)
def test_fetch_fold(spark, outcomes, status, payload, error, tallies):
    log = spark.createDataFrame([("u", s, ok, p, e, e and "retryable", 2, T) for s, ok, p, e in outcomes], LOG)
    none = spark.createDataFrame([], "url string, scrape_status string, payload string, attempts bigint, first_at timestamp")
    r = merge.fold_fetches(log, none).first()
    assert (r.scrape_status, r.payload, r.last_error, r.attempts) == (status, payload, error, 2 * len(outcomes))
    assert {x.outcome: x.n for x in merge.fetch_tallies(log, none).collect()} == tallies


def test_failed_fetch_never_replaces_a_page(spark):
    stored = spark.createDataFrame([("u", "ok", "page", 3, T)], "url string, scrape_status string, payload string, attempts bigint, first_at timestamp")
    log = spark.createDataFrame([("u", 1, False, None, "e", "permanent", 1, T)], LOG)
    r = merge.fold_fetches(log, stored).first()
    assert (r.scrape_status, r.payload, r.attempts, r.last_error_kind) == ("ok", "page", 4, "permanent")
    assert merge.fetch_tallies(log, stored).first().outcome == "kept_ok"


def test_tallies_of_a_hot_url(spark):
    rows = [("hot", n, n % 7 == 3, "p" if n % 7 == 3 else None) for n in range(300)] + [(f"u{n}", n, n % 2 == 0, "p" if n % 4 == 0 else "") for n in range(100)] + [(None, 1, True, "p")]
    log = spark.createDataFrame(rows, "url string, seq int, ok boolean, payload string")
    stored = spark.createDataFrame([("u1", "ok", "p"), ("u2", "failed", "p"), ("u3", "ok", None), ("hot", "failed", None)], "url string, scrape_status string, payload string")
    want, held = {"ok": 0, "kept_ok": 0, "failed": 0}, {"u1"}
    for url, _, ok, payload in sorted(rows[:-1], key=lambda r: r[1]):
        good = ok and bool(payload)
        want["ok" if good else "kept_ok" if url in held else "failed"] += 1
        held |= {url} if good else set()
    assert {r.outcome: r.n for r in merge.fetch_tallies(log, stored).collect()} == want


def test_dead_letters(spark):
    old = spark.createDataFrame([("a", "e", "T", "s", T, 1), ("b", "e", "T", "s", T, 1)], "url string, error string, error_type string, content_sha256 string, failed_at timestamp, attempts int")
    batch = spark.createDataFrame([("a", "x" * 5000, "U", "s2"), ("c", None, None, None)], "url string, error string, error_type string, content_sha256 string")
    got = {r.url: r for r in merge.dead_letters(old, batch, spark.createDataFrame([("b",)], "url string"), F.lit(T)).collect()}
    assert set(got) == {"a", "c"} and got["a"].attempts == 2 and len(got["a"].error) == 2000


def test_selection_buckets(spark):
    urls = spark.createDataFrame([(u, m) for u, m in [("new", None), ("retry", None), ("gone", None), ("tired", None), ("fresh", None), ("changed", datetime(2026, 3, 1)), ("old", None)]], "url string, lastmod timestamp")
    d = datetime(2026, 2, 1)
    doms = spark.createDataFrame([("retry", "failed", d, 1, "retryable"), ("gone", "failed", d, 1, "permanent"), ("tired", "failed", d, 3, "retryable"), ("fresh", "ok", d, 1, None), ("changed", "ok", d, 1, None), ("old", "ok", datetime(2025, 1, 1), 1, None)], "url string, scrape_status string, fetched timestamp, attempts int, last_error_kind string")
    b = select.scrape_buckets(urls, doms, F.lit("2026-01-01").cast("timestamp"))
    assert [tuple(r) for r in select.first_pending(b).collect()] == [("new", 0), ("retry", 1), ("changed", 2), ("old", 2)]
    assert select.first_pending(b, 2).count() == 2


def test_namespace_filter(spark):
    assert select.namespace_names(" 'a', \"b/c\" ,") == ["a", "b/c"] and select.namespace_names("") is None and select.namespace_names(["x"]) == ["x"]
    df = spark.createDataFrame([("memes",), ("memes/events",), ("memesque",), (None,)], "namespace string")
    assert select.in_namespaces(df, ["memes"]).count() == 2 and select.in_namespaces(df, ["unknown"]).count() == 1 and select.in_namespaces(df, None).count() == 4
    with pytest.raises(ValueError, match="of 4 rows memes: 2, none: 0"):
        select.in_namespaces(df, ["memes", "none"], check=True)


def test_versions_and_chunks(spark):
    c = spark.createDataFrame([("a", "1", None), ("b", "1", "p"), ("c", None, "p")], "url string, sha string, pv string")
    done = spark.createDataFrame([("a", "1", None), ("b", "2", "p")], "url string, sha string, pv string")
    assert [r.url for r in select.pending_versions(c, [done], ["url", "sha", "pv"]).orderBy("url").collect()] == ["b", "c"]
    n = select.chunks(spark.range(1000), 300, ["id"], 7)
    assert all(r.chunk == r.id // 300 for r in n.collect())


def test_frequency_join_keeps_every_row(spark):
    df = spark.range(3000).selectExpr("id", "case when id % 3 = 0 then 'hot' when id = 1 then null else concat('k', id % 700) end as key")
    work = Workspace(spark, "t")
    j = join_frequencies(df, work.write(frequencies(df, "key"), "f"), "key")
    want = {r.key: r.n for r in df.where("key is not null").groupBy("key").agg(F.count("*").alias("n")).collect()}
    assert j.count() == df.where("key is not null").count() and all(want[r.key] == r.df for r in j.collect())
