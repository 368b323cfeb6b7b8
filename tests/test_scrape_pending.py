from datetime import datetime, timezone

import pytest

from quillmesh.corpus import Corpus
from quillmesh.plans import state
from quillmesh.sources import readers

FORMS = ["2026-03-05", "2026/03/05", "2026-03-05T10:00:00+01:00", "20260305T100000Z", "Thu, 05 Mar 2026 10:00:00 GMT", "March 5, 2026", "1772704800", "1772704800000"]
EARLIER = ["2026-02-20", "2026/02/20", "Fri, 20 Feb 2026 10:00:00 GMT", "1771581600", "no date", None]


def test_corpus_finds_stale_pages_by_every_form_of_lastmod(spark, tmp_path):
    c = Corpus(spark, str(tmp_path / "corpus"), now=datetime(2026, 3, 1, tzinfo=timezone.utc))
    c.discover(spark.createDataFrame([(f"https://x.example/memes/{i}", "2026-01-01") for i in range(len(FORMS + EARLIER))], "url string, lastmod string"))
    c.save_outcomes(spark.createDataFrame([(f"https://x.example/memes/{i}", True, "<p>x</p>", 200, None, None, 1) for i in range(len(FORMS + EARLIER))], readers.OUTCOME))
    dates = spark.createDataFrame([(f"https://x.example/memes/{i}", t) for i, t in enumerate(FORMS + EARLIER)], "url string, lastmod string")
    c.table("urls").merge(dates, "url", {}, insert=False)
    assert sorted(int(r.url.rsplit("/", 1)[1]) for r in c.pending_scrape().collect()) == list(range(len(FORMS)))


@pytest.fixture
def folder(spark, tmp_path):
    at = datetime(2026, 1, 2, tzinfo=timezone.utc)
    urls = [(i, f"u{i}", True, t, at) for i, t in enumerate([*FORMS, *EARLIER, "2026-02-20"])]
    spark.createDataFrame(urls, "url_id bigint, url string, confirmed boolean, lastmod string, discovered_at timestamp").write.parquet(f"{tmp_path}/urls.parquet")
    fetched = ["2026-03-01 00:00:00"] * (len(urls) - 1) + ["Mar 1, 2026 12:00 AM"]
    first = datetime(2026, 1, 1, tzinfo=timezone.utc)
    doms = [(i, f"u{i}", "ok", t, 1, first, 1, None, at) for i, t in enumerate(fetched)]
    spark.createDataFrame(doms, "dom_id bigint, url string, scrape_status string, fetched_at string, worker_id int, first_fetched_at timestamp, attempts bigint, last_error_kind string, received_at timestamp").write.parquet(f"{tmp_path}/doms.parquet")
    spark.createDataFrame([(1, "Europe/Berlin")], "worker_id int, zone_name string").write.parquet(f"{tmp_path}/workers.parquet")
    return str(tmp_path)


def test_query_reads_every_form_and_the_last_fetch(spark, folder):
    got = {r.url: r.bucket for r in state.scrape_pending_all_forms(spark, folder).collect()}
    assert got == {f"u{i}": 2 for i in range(len(FORMS))}
