import gzip
import json

import pytest
from pyspark.sql import functions as F

from quillmesh.functions import dom
from quillmesh.functions.html import clean, tags
from quillmesh.operators import pages
from quillmesh.operators.reports import flatten, top_with_rest, trend_series
from quillmesh.site import SiteProfile
from quillmesh.sources import readers

PAGE = """<html><head><link rel="canonical" href="https://memearchive.example/memes/cat"><meta property="og:title" content="Cat | Meme Archive"><meta name="description" content="a &amp; b"><meta property="og:image" content="https//img.example/c.png"></head><body>
<h1 class="entry-title">Cat</h1><h5 class="parent"><a href="/memes/animals">Animals</a></h5>
<dl><dt>Status</dt><dd>Confirmed</dd><dt>Year:</dt><dd>c. 2012</dd><dt>Origin</dt><dd>Forum</dd><dt>Type:</dt><dd><a href="/types/image-macro">x</a>, <a href="/types/Loud Noise">y</a></dd><dt>Region</dt><dd>US, us , JP</dd><dt>Badges:</dt><dd>NSFW, Old</dd></dl>
<dl id="entry_tags"><dt>Tags</dt><dd><a data-tag="1">Cat</a> <a data-tag="2">cat</a></dd><dt>Additional References</dt><dd><a href="https;//ref.example/a">Ref</a></dd></dl>
<section class="bodycopy"><p>lost</p><h2 id="about">About</h2><p>First <a href="/memes/dog#x">dog</a><a href="javascript:void(0)">no</a></p><p>trends.embed.renderExploreWidget()</p><table><tr><td>toc</td></tr></table><h2>Origins:</h2><p>Then</p><img class="i" data-src="/a.png" alt="A"><h4>Template / GIF</h4><p></p><h2>Spread</h2><p>Far</p></section>
<div class="references"><a href="#r1">[1]</a><a href="https://x.example/1">One</a><a href="https://x.example/2">Two</a></div>
<div class="entry-timestamps">Updated <abbr class="timeago" title="2026-01-01T00:00:00Z">x</abbr> Added <abbr class="timeago" title="2025-01-01T00:00:00+00:00">y</abbr></div></body></html>"""


def parsed(spark, rows):
    return pages.parse_pages(spark.createDataFrame(rows, "url string, html string, content_sha256 string"))


def test_entry_page(spark):
    entries, failures = pages.entries_and_failures(parsed(spark, [("https://memearchive.example/memes/cat?x", PAGE, "s")]), "1.0")
    r = entries.first()
    assert failures.count() == 0
    assert (r.url, r.source_url, r.title, r.category, r.status, r.year, r.origin) == ("https://memearchive.example/memes/cat", "https://memearchive.example/memes/cat?x", "Cat", "meme", "confirmed", 2012, "Forum")
    assert (r.entry_type, r.region, r.tags, r.badges) == (["image-macro", "/types/loud-noise"], ["US", "JP"], ["Cat"], ["NSFW", "Old"])
    assert r.og_image == "https://img.example/c.png" and r.series_parent == "https://memearchive.example/memes/animals" and (r.updated, r.added) == (1767225600, 1735689600)
    assert [(s.heading, s.kind, s.level, s.text) for s in r.sections] == [("About", "about", 2, ["First dog no"]), ("Origins:", "origin", 2, ["Then"]), ("Template / GIF", "template", 3, []), ("Spread", "spread", 2, ["Far"])]
    assert [x.url for x in r.sections[0].links] == ["https://memearchive.example/memes/dog"] and r.sections[1].images[0].src == "https://memearchive.example/a.png"
    assert [(x["index"], x.url) for x in r.external_references] == [(1, "https://x.example/1"), (None, "https://x.example/2")] and r.additional_references[0].url == "https://ref.example/a"
    assert (r.corpus_status, r.corpus_missing, r.meta["description"]) == ("ready", [], "a & b")


def test_failures_are_rows(spark):
    rows = [("u1", None, "a"), ("u2", "", "b"), ("https://other.example/x", "<p>hi", "c"), ("https://memearchive.example/m/x", "<p>hi", "d"), (None, "<p>hi", "e")]
    entries, failures = pages.entries_and_failures(parsed(spark, rows), "1")
    assert entries.count() == 0
    got = {r.content_sha256: r.error for r in failures.collect()}
    assert got["a"] == got["b"] == "empty page" and got["c"] == "url: host not allowed" and got["d"] == "origin: missing" and "canonical" in got["e"]
    assert parsed(spark, []).count() == 0


@pytest.mark.parametrize(("lack", "status"), [({}, "ready"), ({"year": False}, "ready")])
def test_policy(spark, lack, status):
    entries, _ = pages.entries_and_failures(parsed(spark, [("u", PAGE, "s")]), "1", pages.Policy(**lack))
    assert entries.first().corpus_status == status
    thin = PAGE.replace('<h2 id="about">About</h2>', "").replace("c. 2012", "long ago")
    e, _ = pages.entries_and_failures(parsed(spark, [("u", thin, "s")]), "1", pages.Policy(**lack))
    assert e.first().corpus_missing == [x for x in ("year", "section:about") if lack.get(x, True)]


def test_structure_ignores_text_and_generated_classes():
    one, n, depth, cut = dom.structure('<html><body><div class="b a x9 c d"><p>x<p>y</div></body></html>')
    two, *_ = dom.structure('<html><body><div class="b a x7 c d"><p>longer text<p>z</div></body></html>')
    assert one == two and one["div.a.b.c"] == 1 and one["div.a.b.c>p"] == 2 and n == 5 and depth == 3 and not cut
    assert dom.structure("<div>" + "<p>x</p>" * 100 + "</div>", most_nodes=10)[1::2] == (10, True)
    assert "script" not in dom.structure("<div><script><p></script><svg><path/></svg></div>")[0]
    assert dom.structure("<div>" * 200)[1:] == (61, 60, True) and dom.structure("<div>" * 200, None, None)[1:] == (200, 199, False)
    assert dom.structure("<i class='e d c b a'>", most_classes=None)[0] == {"i.a.b.c.d.e": 1}


def test_structure_isolates_bad_pages(spark):
    df = spark.createDataFrame([(1, "<p>x"), (2, ""), (3, None)], "dom_id int, html string").withColumn("url", F.lit("u"))
    got = {r.dom_id: r for r in pages.structure_tokens(df).collect()}
    assert got[1].error is None and got[1].tokens == {"p": 1} and got[2].error == got[3].error == "empty page"


def test_tokenizer_and_clean():
    html = "<!-- <p> --><script>'<b>'</script><p title='a > b'>x &amp;&nbsp;y</p>"
    assert [t[3] for t in tags(html)] == ["", "", "p", "p"] and clean(" x &amp;&nbsp; y\n") == "x & y"


NEXT = {
    '<link rel="next" href="/a/page/9">': "https://e.example/a/page/9", '<a class="next_page" href="?page=2">': "https://e.example/a?page=2", '<a href="/z">Next ›</a>': "https://e.example/z",
    '<a class="page-button" href="/q"><i class="fa fa-chevron-right"></i></a>': "https://e.example/q", '<a href="/a/page/2/">2</a>': "https://e.example/a/page/2/", '<a href="https://other.example/a/page/2">2</a>': None, "<p>": None,
}


@pytest.mark.parametrize("html", list(NEXT))
def test_next_page(html):
    assert dom.next_page(html, "https://e.example/a") == NEXT[html]


def test_sitemaps(spark):
    urls = b'<?xml version="1.0"?><urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9"><url><loc> https://e/1 </loc><lastmod>2026-01-01</lastmod></url><url><loc>https://e/2</loc></url><url><lastmod>x</lastmod></url></urlset>'
    index = b"<sitemapindex><sitemap><loc>https://e/s.xml</loc></sitemap></sitemapindex>"
    files = spark.createDataFrame([("a", gzip.compress(urls)), ("b", index), ("c", b"<broken"), ("d", b"<other/>"), ("e", None)], "source string, raw binary")
    got = sorted((tuple(r) for r in readers.sitemaps(files).collect()), key=repr)
    assert got == [("a", "url", "https://e/1", "2026-01-01"), ("a", "url", "https://e/2", None), ("b", "index", "https://e/s.xml", None)]


def test_text_readers(spark, tmp_path):
    (tmp_path / "robots.txt").write_text("User-agent: *\nSITEMAP: https://e/s.xml\nsitemap:https://e/t.xml\n")
    assert {r.loc for r in readers.robots_sitemaps(spark, str(tmp_path / "robots.txt"), "f").collect()} == {"https://e/s.xml", "https://e/t.xml"}
    (tmp_path / "none.txt").write_text("User-agent: *\n")
    assert readers.robots_sitemaps(spark, str(tmp_path / "none.txt"), "f").first().loc == "f"
    for name, text in (("bare", json.dumps([{"url": "a", "n": 1}, {"url": "a", "n": 2}])), ("wrapped", json.dumps({"urls": [{"url": "a", "n": 2}]})), ("bad", "{nope")):
        (tmp_path / name).write_text(text)
        assert [tuple(r) for r in readers.json_index(spark, str(tmp_path / name), "url string, n int").collect()] == ([] if name == "bad" else [("a", 2)])
    (tmp_path / "t.nt").write_text('<s> <p> <o> .\n<s> <q> "lit"@en .\nbad\n')
    assert sorted(tuple(r) for r in readers.triples(spark, str(tmp_path / "t.nt")).collect()) == [("s", "p", "o"), ("s", "q", '"lit"@en')]


WHOLE = "<!doctype html>\n<HTML lang=en><p>" + "An owl sleeps by day, and that is all. " * 60
REPLIES = {
    "a page at once": (["200 whole"], "ok", 1), "a page after refusals of service": (["503", "429", "200 whole"], "ok", 3), "gone": (["405 Method Not Allowed"], "permanent", 1), "bad request after a timeout": (["timeout", "422"], "permanent", 2),
    "never": (["500 down", "timeout", "200 short"], "retryable", 3), "not a page": (["200 text", "200 text", "302"], "retryable", 3),
}


def answering(replies):
    """A transport that gives the named replies in turn."""
    bodies, left = {"whole": WHOLE, "short": "<html>", "text": "x" * 5000}, iter(replies)

    def transport(_):
        first, _, rest = next(left).partition(" ")
        if first == "timeout":
            raise TimeoutError("no answer in 30 s")
        return int(first), bodies.get(rest, rest)

    return transport


@pytest.mark.parametrize("name", list(REPLIES))
def test_fetch_outcomes(name):
    replies, kind, used = REPLIES[name]
    waited = []
    config = readers.FetchConfig(readers.Backoff(attempts=3, first=10, growth=3, most=25, jitter=0.5))
    got = readers.fetch_one("u", answering(replies), config, sleep=waited.append)
    assert (got["ok"], got["error_kind"], got["attempts_used"], got["html"]) == (kind == "ok", None if kind == "ok" else kind, used, WHOLE if kind == "ok" else None)
    assert len(waited) == used - 1 and all(m / 2 <= w <= m for w, m in zip(waited, (10, 25), strict=False))
    told = {"never": (200, "thin_body: 6 characters"), "gone": (405, "405: Method Not Allowed"), "bad request after a timeout": (422, "422"), "not a page": (302, "302")}
    assert (got["status_code"], got["error"]) == told.get(name, (200, None))


def test_errors_keep_their_detail():
    got = readers.fetch_one("u", answering(["timeout"]), readers.FetchConfig(readers.Backoff(attempts=1)))
    assert got["error"] == "transport: TimeoutError: no answer in 30 s" and got["status_code"] is None
    assert len(readers.fetch_one("u", answering(["404 " + "x" * 5000]))["error"]) < 300


def test_a_refused_key_stops_all():
    for status in ("401", "403"):
        with pytest.raises(readers.AuthError):
            readers.fetch_one("u", answering([status]), sleep=lambda _: None)
    assert list(readers.DISCOVERY.pauses()) == [4, 16, 64, 256, None]
    waited = []
    assert readers.reply("u", answering(["500", "timeout", "200 fine"]), readers.DISCOVERY, waited.append) == "fine" and waited == [4, 16]
    assert readers.reply("u", answering(["404"]), readers.DISCOVERY, waited.append) is None


def test_crawl_parameters():
    assert readers.CrawlConfig.from_parameters({"most_pages": "0", "most_empty": "", "delay": None}) == readers.CrawlConfig() and readers.CrawlConfig().most_pages is None
    assert readers.CrawlConfig.from_parameters({"most_pages": 7, "most_empty": "2", "delay": "0.5", "other": 1}) == readers.CrawlConfig(7, 2, 0.5)


def listing_site(pages, base="https://e.example"):
    """A site of listings: path -> (links of each page)."""
    out = {}
    for path, shown in pages.items():
        for n, links in enumerate(shown, 1):
            here, following = (f"{path}/page/{k}" if k > 1 else path for k in (n, n + 1))
            out[base + here] = "".join(f'<a href="{x}">x</a>' for x in links) + (f'<a rel="next" href="{following}">on</a>' if n < len(shown) else "")
    return out


def test_entry_rule_for_one_link_is_that_of_columns(spark):
    from quillmesh.functions.urls import is_entry_url

    site = SiteProfile()
    urls = ["https://memearchive.example/memes/a", "/memes/a?x=1", "//www.memearchive.example/people/b/", "memes/x", "https://other.example/memes/a", "/memes", "/memes/12", "/memes/all", "/about/a", "", "https://memearchive.example", "mailto:x", "/memes/events/e#f", "/memes//"]
    got = {r.u: r.e for r in spark.createDataFrame([(u,) for u in urls], "u string").select("u", is_entry_url(F.col("u"), site).alias("e")).collect()}
    assert got == {u: site.is_entry(u) for u in urls} and sum(got.values()) == 5


def test_fetch_and_crawl(spark):
    site = listing_site({"/memes/new": [["/memes/a", "/memes/known"], ["/memes/b?x=1", "/about"], [], [], ["/memes/c"]], "/memes/all": [["/memes/a", "/memes/d"]]})
    profile = SiteProfile(base_url="https://e.example", hosts=("e.example",))
    listings = spark.createDataFrame([("/memes/new", False, 1), ("/memes/all", True, 2), ("/memes/gone", True, 3)], "path string, confirmed boolean, place int")
    known = spark.createDataFrame([("https://e.example/memes/known",)], "url string")
    answer = lambda u: (200, site[u]) if u in site else (404, "")

    def crawled(frame=listings, **bounds):
        return sorted((r.url[-1], r.listing[-3:], r.confirmed) for r in readers.crawl_listing(spark, frame, answer, known, profile, readers.CrawlConfig(**bounds)).collect())

    assert crawled() == [("a", "new", False), ("b", "new", False), ("c", "new", False), ("d", "all", True)]
    assert crawled(most_pages=1) == [("a", "new", False), ("d", "all", True)] and crawled(most_empty=1) == [("a", "new", False), ("b", "new", False), ("d", "all", True)]
    assert crawled(listings.drop("place"))[0] == ("a", "all", True)
    out = readers.fetch(spark.createDataFrame([("u1",), ("u2",), (None,)], "url string"), lambda u: (200, WHOLE) if u == "u1" else (404, ""))
    assert sorted((r.url, r.ok) for r in out.collect()) == [("u1", True), ("u2", False)]


def test_reports(spark):
    s = {"a": 1, "b": True, "c": {"x": 1, "y": 2.5}, "d": {"e": {"f": 3}, "t": "x"}, "big": {str(i): i for i in range(10)}, "n": None, "l": [1]}
    df = spark.createDataFrame([("r", json.dumps(s)), ("bad", "{"), ("none", None), ("list", "[1]")], "k string, s string")
    got = {r.path: (r.grp, r.trend) for r in flatten(df, "k", "s").collect()}
    assert got["a"] == ("", True) and got["c.y"] == ("c", True) and got["d.e.f"] == ("d.e", True) and got["big.3"] == ("big", False) and "b" not in got and "n" not in got
    t = spark.createDataFrame([("g", f"n{i:02}", i) for i in range(5)], "g string, name string, v int")
    assert [(r.name, r.v) for r in top_with_rest(t, ["g"], "name", "v", 3).orderBy("rank").collect()] == [("n04", 4), ("n03", 3), ("n02", 2), ("(+2 more)", 1)]
    one = spark.createDataFrame([("a", "2026-01-01", 1.0)], "path string, at string, value double")
    assert trend_series(one).count() == 0


def test_parent_of_a_series(spark):
    e = spark.createDataFrame([("a", None, "A"), ("b", "a", "B"), ("c", "gone", "C"), (None, None, None)], "url string, series_parent string, title string")
    assert {r.title: r.parent_title for r in pages.with_parent(e, "title").collect()} == {"A": None, "B": "A", "C": None, None: None}
