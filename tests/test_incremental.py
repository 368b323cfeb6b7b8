from datetime import datetime

import pytest
from pyspark.sql import functions as F

from quillmesh.operators.incremental import Ledger, latest, pending_stages, succeeded_runs, unprocessed

T = lambda d, h=0: datetime(2026, 1, d, h)


def changes(spark, rows):
    return spark.createDataFrame(rows, "k string, v string, seen timestamp, extra string")


def test_runs_skip_nothing_and_repeat_nothing(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path / "l"), "k string, v string")
    all_rows = [("a", "1", T(1), None), ("b", "1", T(1), "x"), (None, "1", T(1), None)]
    take = lambda: ledger.pending(changes(spark, all_rows), F.col("seen"), ["k"], "v").select("k", "v")
    first = take()
    assert {tuple(r) for r in first.collect()} == {("a", "1"), ("b", "1"), (None, "1")}
    # A run that fails after its pairs are written but before its commit leaves nothing that counts.
    first.write.mode("overwrite").parquet(str(tmp_path / "l/pairs/run=r1"))
    assert take().count() == 3
    ledger.commit("r1", first, T(2), oldest_open=T(1, 12))
    assert take().count() == 0
    # A row of a transaction that was open at that commit appears later with an old time, and a changed version of an old key.
    all_rows += [("c", "1", T(1, 13), None), ("a", "2", T(3), None), ("a", "2", T(3), "repeated")]
    assert sorted(tuple(r) for r in take().distinct().collect()) == [("a", "2"), ("c", "1")]
    # Rows before the horizon aren't read again.
    all_rows.append(("z", "1", T(1, 1), None))
    assert "z" not in {r.k for r in take().collect()}
    second = take()
    ledger.commit("r2", second, T(4), None)
    ledger.commit("r2", second, T(4), None)
    assert ledger.processed().where("k = 'c'").count() == 1
    # After a commit without an open transaction the horizon is open again; the ledger alone decides.
    assert {r.k for r in take().collect()} == {"z"}


def test_unprocessed_treats_null_as_a_value(spark):
    a, b = spark.createDataFrame([("a", None), ("b", "1")], "k string, v string"), spark.createDataFrame([("a", None)], "k string, v string")
    assert [r.k for r in unprocessed(a, b, ["k"], "v").collect()] == ["b"]
    assert unprocessed(a.limit(0), b, ["k"], "v").count() == 0


def test_latest_breaks_ties_by_the_next_order(spark):
    df = spark.createDataFrame([("a", 1, 1, "x"), ("a", 1, 2, "y"), ("a", None, 9, "z"), ("b", None, 1, "w")], "k string, t int, i int, v string")
    assert [tuple(r) for r in latest(df, ["k"], [F.col("t"), F.col("i")], ["v"]).collect()] == [("a", "y")]


def test_succeeded_runs_takes_the_last_state(spark):
    rows = [("r1", "success", T(1)), ("r1", "failed", T(2)), ("r2", "running", T(1)), ("r2", "success", T(2)), ("r2", "success", T(2)), (None, "success", T(3)), ("r3", None, T(1))]
    runs = spark.createDataFrame(rows, "run_id string, state string, created_at timestamp")
    assert [r.run_id for r in succeeded_runs(runs).collect()] == ["r2"]


@pytest.mark.parametrize("empty", [False, True])
def test_pending_stages(spark, empty):
    urls = spark.createDataFrame([("u1", True, None), ("u2", True, 50), ("u2", False, 500), ("u3", True, 100), ("u4", False, 900), ("u5", None, None), (None, True, 1), ("u6", True, 1)], "url string, confirmed boolean, lastmod_us bigint")
    fetches = spark.createDataFrame([(1, "u2", "h2", 100, T(1)), (2, "u3", "old", 90, T(1)), (3, "u3", "h3", 200, T(2)), (4, "u4", "h4", 100, T(1)), (5, "u6", "h6", None, T(1))], "dom_id bigint, url string, version string, fetched_us bigint, received_at timestamp")
    entries = spark.createDataFrame([("u3", "H3", "ok", T(1), 1), ("u3", "other", "bad", T(9), 2), ("u4", "stale", "ok", T(2), 3)], "url string, dom_content_sha256 string, run_id string, parsed_at timestamp, entry_id bigint")
    runs = spark.createDataFrame([("ok", "success", T(1)), ("bad", "failed", T(1))], "run_id string, state string, created_at timestamp")
    if empty:
        urls, fetches = urls.limit(0), fetches.limit(0)
    fetches = fetches.where("fetched_us is not null")
    got = sorted(tuple(r) for r in pending_stages(urls, fetches, entries, runs).collect())
    assert got == ([] if empty else [("u1", "fetch"), ("u2", "fetch"), ("u2", "parse"), ("u4", "parse"), ("u6", "fetch")])
