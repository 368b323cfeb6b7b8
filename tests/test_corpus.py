from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from quillmesh import __main__ as cli
from quillmesh.corpus import Corpus, run_id
from quillmesh.operators import clustering
from quillmesh.site import SiteProfile
from quillmesh.sources import readers, tables
from test_pages_sources import PAGE

BASE = "https://memearchive.example/memes/"
NOW = datetime(2026, 3, 1, tzinfo=timezone.utc)


def html(name, kind):
    body = {"a": "<p class='lead'>x</p><p>y</p>", "b": "<table class='t'><tr><td>x</td></tr></table>", "c": "<ul class='u'><li>x</li><li>y</li></ul><figure><img></figure>"}[kind]
    return PAGE.replace("/memes/cat", f"/memes/{name}").replace("</body>", body * 3 + "<i>pad</i>" * 300 + "</body>")


def test_stages_end_to_end(spark, tmp_path):
    c = Corpus(spark, str(tmp_path / "corpus"), now=NOW)
    names = [f"{k}{i}" for k in "abc" for i in range(6)]
    entries = spark.createDataFrame([(BASE + n, "2026-01-01") for n in names] + [(BASE + "gone", "2026-01-01"), (BASE + "bare", None), (None, "x")], "url string, lastmod string")
    assert c.discover(entries) == {"added": 20, "updated": 0} and c.discover(entries) == {"added": 0, "updated": 0}
    assert c.pending_scrape().count() == 19 and c.pending_scrape(limit=3).count() == 3 and c.pending_scrape(confirmed_only=False).count() == 20

    site = {BASE + n: html(n, n[0]) if n != "c5" else "<html><body>" + "no origin here " * 300 for n in names}
    transport = lambda url: (200, site[url]) if url in site else (404, "")
    assert c.scrape(transport, readers.FetchConfig(readers.Backoff(attempts=1))) == {"ok": 18, "failed": 1, "kept_ok": 0}
    assert c.pending_scrape().count() == 0 and c.pending_scrape(refetch_days=1).count() == 0
    assert c.read("urls").where("last_scraped is not null").count() == 18
    bad = spark.createDataFrame([(BASE + "a0", False, None, 500, "boom", "retryable", 2)], readers.OUTCOME)
    assert c.save_outcomes(bad) == {"ok": 0, "failed": 0, "kept_ok": 1}
    r = c.read("doms").where(F.col("url") == BASE + "a0").first()
    assert r.scrape_status == "ok" and r.attempts == 3 and r.last_error == "boom" and tables.page_of(c.read("doms"), BASE + "a0") == r.html
    assert tables.page_of(c.read("doms"), "nowhere") is None

    assert c.parse() == {"asked": 18, "ready": 17, "incomplete": 0, "failed": 1, "skipped": 0} and c.parse()["asked"] == 0
    assert c.read("parse_failures").first().url == BASE + "c5" and c.failures_by_namespace().first().namespace == "memes"
    fixed = spark.createDataFrame([(BASE + "c5", True, html("c5", "c"), 200, None, None, 1)], readers.OUTCOME)
    c.save_outcomes(fixed)
    assert c.parse()["ready"] == 1 and c.read("parse_failures").count() == 0 and c.read("entries").count() == 18

    assert c.extract() == {"added": 18, "updated": 0, "failed": 0} and c.extract()["added"] == 0
    m = c.cluster(clustering.Config(algorithm="kmeans", k=3, seeds=3, components=3), write_back=True)
    assert m["n_clusters"] == 3 and m["matched"] == 18 and m["run_id"] == run_id(NOW)
    f = {r.url[len(BASE)]: set() for r in c.read("dom_features").collect()}
    for r in c.read("dom_features").collect():
        f[r.url[len(BASE)]].add(r.cluster_id)
    assert all(len(v) == 1 for v in f.values()) and len(set.union(*f.values())) == 3
    docs = c.read("dom_clusters").collect()
    assert len(docs) == 3 and all(d["size"] == 6 and d.top_tokens and d.medoid_url in d.sample_urls and d.namespaces == {"memes": 6} for d in docs)
    c.cluster(clustering.Config(algorithm="kmeans", k=3, seeds=1, components=3))
    assert c.read("cluster_runs").count() == 1 and c.read("dom_clusters").count() == 3

    assert [r.cluster_id for r in c.clusters(run_id(NOW)).collect()] == [0, 1, 2]
    some = c.read("dom_features").where(F.col("url").isin(BASE + "a1", BASE + "b1")).select("url", F.lit(None).cast("string").alias("cluster_run_id"), "cluster_id")
    own = {r.url: r.cluster_id for r in some.collect()}
    c.table("dom_features").merge(some.drop("cluster_id").withColumn("cluster_id", F.lit(None).cast("int")), "url", {})
    assert c.assign(run_id(NOW)) == {"added": 0, "updated": 2}
    assert {r.url: r.cluster_id for r in c.read("dom_features").where(F.col("url").isin(*own)).collect()} == own
    report = c.sample_report(5)
    assert report["entries"] == 5 and report["coverage"]["title"] == 1.0

    s = c.stats()
    assert s["features"]["clustered"] == 18 and s["latest_run"]["run_id"] == run_id(NOW) and s["latest_run"]["n_clusters"] == 3
    assert s["urls"]["confirmed"] == 19 and s["doms"]["permanent"] == 1 and s["entries"] == {"total": 18, "ready": 18}
    c.save_summary("parse", "r1", s)
    c._now = datetime(2026, 3, 2, tzinfo=timezone.utc)
    c.save_summary("parse", "r1", s)
    c.save_summary("parse", "r2", s)
    h = c.history("parse").collect()
    assert [r.run_id for r in h] == ["r1", "r2"] and c.history("scrape").count() == 0 and c.trends("parse").where("path = 'doms.total'").count() == 2


def test_crawl_adds_unknown_urls(spark, tmp_path):
    site = SiteProfile(listings=(("/memes/all", False), ("/memes/confirmed", True)))
    c = Corpus(spark, str(tmp_path / "c"), site, now=NOW)
    pages = {"https://memearchive.example/memes/all": '<a href="/memes/x">x</a>', "https://memearchive.example/memes/confirmed": '<a href="/memes/x">x</a><a href="/memes/y">y</a>'}
    answer = lambda u: (200, pages[u]) if u in pages else (404, "")
    assert c.crawl(answer) == {"added": 2, "updated": 0} and c.crawl(answer)["added"] == 0
    assert {(r.url[-1], r.confirmed) for r in c.read("urls").collect()} == {("x", False), ("y", True)}
    assert c.infer_site().patterns[0][1] == "memes"


def test_command_line_arguments():
    a = cli.arguments(["c", "sweep", "--algorithm", "kmeans", "--k", "4,8", "--min-df", "2,3"])
    assert [(x.k, x.min_df) for x in cli.configs(a)] == [(4, 2), (8, 2), (4, 3), (8, 3)]
    both = cli.configs(cli.arguments(["c", "sweep", "--algorithm", "both", "--k", "4 8", "--min-cluster-size", "50", "--components", "10,20", "--weights", "both"]))
    assert len(both) == 2 * 2 * 3 and {(x.algorithm, x.binary, x.components) for x in both} == {(a, b, c) for a in ("kmeans", "hdbscan") for b in (True, False) for c in (10, 20)}
    with pytest.raises(SystemExit):
        cli.arguments(["c", "sweep", "--k", "four"])
    assert cli.arguments(["c", "parse", "--force", "--namespaces", "memes"]).namespaces == "memes"


def test_shapes_of_triples_as_text(spark):
    from quillmesh.operators import rdf

    rows = [("a", "is", "urn:owl"), ("b", "is", "urn:owl"), ("a", "age", '"3"'), ("b", "age", '"7"'), ("a", "name", '"Ann"@en'), ("a", "size", '"1.5"'), ("b", "size", '"2"'), ("a", "kin", "http://x/1"), ("a", "kin", '"none"')]
    t = spark.createDataFrame(rows, "s string, p string, o string")
    assert {r.p: r.kind for r in rdf.value_kinds(t).collect()} == {"is": "name", "age": "integer", "name": "text", "size": "decimal", "kin": "any"}
    shapes = rdf.shape(t).join(rdf.value_kinds(t), "p")
    told = rdf.shacl(shapes, "Owl", "urn:owl").first().text
    assert "sh:targetClass <urn:owl>" in told and "sh:path <age> ; sh:minCount 1 ; sh:maxCount 1 ; sh:datatype xsd:integer ]" in told and "sh:path <kin> ; sh:maxCount 2 ]" in told
    assert "<name> LITERAL ? ;" in rdf.shex(shapes, "Owl").first().text


def test_parse_report(spark):
    from quillmesh.operators import pages, reports

    thin = PAGE.replace("<dt>Region</dt><dd>US, us , JP</dd>", "").replace('<h2 id="about">About</h2>', "<h2>Odd things</h2>").replace("/memes/cat", "/memes/dog")
    df = spark.createDataFrame([("https://memearchive.example/memes/cat", PAGE, "s"), ("https://memearchive.example/memes/dog", thin, "t"), ("u", "", "e")], "url string, html string, content_sha256 string")
    out = reports.parse_report(*pages.entries_and_failures(pages.parse_pages(df), "1"))
    assert (out["entries"], out["failures"], out["examples"]) == (2, 1, [("u", "empty page")])
    assert out["coverage"]["region"] == 0.5 and out["coverage"]["title"] == 1.0 and out["unknown_headings"] == {"Odd things": 1} and out["missing"] == {"region": 1, "section:about": 1} and out["section_kinds"]["origin"] == 2
