from datetime import datetime, timezone

from pyspark.sql import functions as F

from quillmesh.operators.incremental import Ledger, changed_states, pending_stages, stages_of


def test_stages_from_a_horizon_are_those_of_a_full_run(spark):
    at = lambda day: datetime(2026, 1, day, tzinfo=timezone.utc)
    urls = spark.createDataFrame([("old", True, 5), ("changed", True, 50), ("late", True, 5), ("new", True, 5), ("never", True, None)], "url string, confirmed boolean, lastmod_us bigint")
    fetches = [(1, "old", "a", at(1), 10), (2, "changed", "b", at(1), 10), (3, "late", "c2", at(1), 20), (4, "late", "c1", at(9), 10), (5, "new", "d", at(9), 30)]
    fetches = spark.createDataFrame(fetches, "dom_id bigint, url string, version string, received_at timestamp, fetched_us bigint")
    entries = spark.createDataFrame([(i, u, v, "r", at(2)) for i, (u, v) in enumerate([("old", "a"), ("changed", "b"), ("late", "c2")])], "entry_id bigint, url string, dom_content_sha256 string, run_id string, parsed_at timestamp")
    runs = spark.createDataFrame([("r", "success", at(2))], "run_id string, state string, created_at timestamp")
    full, part = ({tuple(r) for r in pending_stages(urls, fetches, entries, runs, h).collect()} for h in (None, at(5)))
    assert full == part == {("new", "parse"), ("changed", "fetch"), ("never", "fetch")}


def test_runs_through_the_ledger_decide_as_a_full_run_does(spark, tmp_path):
    """Three runs over rows that become visible late, runs that succeed late, reverted content and nulls: each decides on what has changed only,
    and together they say what a run over everything says."""
    at = lambda day: datetime(2026, 1, day, tzinfo=timezone.utc)
    urls = [("a", True, 5, at(1)), ("b", True, 50, at(1)), ("c", False, 5, at(1)), ("c", True, 5, at(6)), ("d", True, None, None), ("e", True, 5, at(1)), ("f", None, 99, at(9)), (None, True, 1, at(1)), ("g", True, 5, at(1))]
    fetches = [(1, "a", "a1", 10, at(1)), (2, "b", "b1", 10, at(2)), (3, "b", "b2", 60, at(8)), (4, "c", "c1", 10, at(3)), (5, "e", "e1", 10, at(1)), (6, "e", "e2", 20, at(4)), (7, "e", "e1", 30, at(9)), (8, "f", None, 10, None), (9, "g", "g1", 10, at(1))]
    entries = [(1, "a", "A1", "r1", at(2)), (2, "b", "b1", "r1", at(2)), (3, "e", "e1", "r1", at(2)), (4, "e", "e2", "r2", at(5)), (5, "c", "c1", "r2", at(5)), (6, "f", None, "r1", at(9)), (7, "g", "g1", "r3", at(2))]
    runs = [("r1", "success", at(2)), ("r2", "running", at(5)), ("r2", "success", at(8)), ("r3", "success", at(3)), ("r3", "failed", at(10))]
    frames = (
        (spark.createDataFrame(urls, "url string, confirmed boolean, lastmod_us bigint, discovered_at timestamp"), "discovered_at"), (spark.createDataFrame(fetches, "dom_id bigint, url string, version string, fetched_us bigint, received_at timestamp"), "received_at"),
        (spark.createDataFrame(entries, "entry_id bigint, url string, dom_content_sha256 string, run_id string, parsed_at timestamp"), "parsed_at"), (spark.createDataFrame(runs, "run_id string, state string, created_at timestamp"), "created_at"),
    )
    ledger, held, decided = Ledger(spark, str(tmp_path / "l"), "url string, version string"), {}, []
    for n, (day, oldest_open) in enumerate(((4, 3), (7, 7), (11, 11))):
        seen = [df.where(F.col(c) < F.lit(at(day))) if n < 2 else df for df, c in frames]
        states = changed_states(ledger, *seen).cache()
        decided.append({r.url for r in states.collect()})
        for u in decided[-1]:
            held.pop(u, None)
        for r in stages_of(states).collect():
            held.setdefault(r.url, set()).add(r.stage)
        # A run that fails before its commit and is repeated finds the same.
        states.select("url", "version").write.mode("overwrite").parquet(str(tmp_path / f"l/pairs/run={n}"))
        assert {r.url for r in changed_states(ledger, *seen).collect()} == decided[-1]
        ledger.commit(str(n), states.select("url", "version"), at(day), at(oldest_open))
        full = {}
        for r in pending_stages(*seen).collect():
            full.setdefault(r.url, set()).add(r.stage)
        assert held == full
    assert "a" not in decided[1] | decided[2] and decided[2] == {"b", "c", "d", "e", "f", "g"}
