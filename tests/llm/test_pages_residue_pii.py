import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillmesh.llm import boilerplate, pii, residue
from quillmesh.llm.boosting import BoostedTrees
from quillmesh.llm.pages import Page
from quillmesh.llm.pii_candidates import PATTERNS, Lexicon, candidates
from quillmesh.llm.residue_patterns import trusted
from quillmesh.session import Workspace

A = "The cat sat on the mat, looked around, and then went away without a word to anyone in the room."
B = "Later, in the year of the dog, the same cat came back, sat down, and stayed for a long while."
NAV = '<div class="x1"><ul><li><a href="/a">Home</a></li><li><a href="/b">Images</a></li></ul></div>'
SIDE = '<div><dl><dt>Status</dt><dd>Confirmed</dd></dl><h4>Recent entries</h4><ul><li><a href="/x">A long sentence in a teaser, which looks like text, but is none.</a></li></ul></div>'
TALK = f"<div><h3>Comments (2)</h3><div><b>someone</b></div><p>I think, well, {B}</p></div>"
FOOT = "<div><p>This site licenses its text for reuse, in part, and so on.</p><p>© 2026. All rights reserved.</p></div>"


def page(body, title="Cat", og="Cat"):
    return f'<html><head><title>{title} | Site</title><meta property="og:title" content="{og}"></head><body>{body}</body></html>'


LAYOUTS = {
    "plain": page(f"{NAV}<div><h1>Cat</h1><p>{A}</p><h2>Origin</h2><p>{B}</p></div>{SIDE}{TALK}{FOOT}"),
    "semantic": page(f"<nav>{NAV}</nav><aside>{SIDE}</aside><main><h1>Cat</h1><p>{A}<p>Sign up today and get a sticker!<p>{B}</main><footer>{FOOT}</footer>"),
    "table": page(f"<table><tr><td>{NAV}{SIDE}</td><td><font size=5><h1>Cat</h1></font>{A}<br>\n<br/>{B}</td></tr></table>{FOOT}"),
    "gallery": page(f"{NAV}<div><h1>Cat</h1><figure><img src=1><figcaption>{A}</figcaption></figure><figure><img src=2><figcaption>{B}</figcaption></figure></div>{SIDE}{FOOT}"),
    "thread": page(f"{NAV}<h1>Cat</h1>" + "".join(f"<div><div>user_{i}</div><div>{i} May</div><div>{t}</div><div>Reply · Quote · Report</div></div>" for i, t in ((1, A), (2, B))) + SIDE + FOOT),
    "careless": page(f"<!-- <p>no</p> --><script>'<p>no</p>'</script>{NAV}<div class=entry><h1>Cat<p>{A[:10]}<b>{A[10:20]}</b>{A[20:]}<p>{B.replace(' ', '&nbsp;', 1)}</div><noscript>Please enable JavaScript.</noscript>"),
}


@pytest.mark.parametrize("name", sorted(LAYOUTS))
def test_main_body_of_each_layout(name):
    assert boilerplate.main_body(LAYOUTS[name]) == [A, B]


ERRORS = {
    "error": page("<div><h1>404 Not Found</h1><p>The page you were looking for could not be found. It may have been moved.</p></div>" + SIDE, "404 Not Found"),
    "script": page("<div><h1>Cat</h1><p>Please enable JavaScript to view this page.</p></div>"),
    "filler": page("<div><h1>Cat</h1><p>Lorem ipsum dolor sit amet, consectetur adipiscing elit.</p><p>Content coming soon.</p></div>"),
    "title": page(f"<div><h1>{{{{title}}}}</h1><p>{A}</p></div>", "{{title}}"),
    "placeholder": page(f"<div><h1>Cat</h1><p>{A}</p><p>Cat was first posted by %MEME_NAME% on a forum in May.</p></div>"),
}
QUOTES = {
    "quote": page(f'<div><h1>Cat</h1><p>{A} In the skit, a cat keeps asking visitors to "please enable JavaScript" before entering.</p></div>'),
    "joke": page(f"<div><h1>Cat</h1><p>{A} Developers joke that {{{{title}}}} is the true name of the cat.</p></div>"),
    "about": page('<div><h1>Oops!</h1><p>The "404 Not Found" screen itself became a meme, and people post it, often.</p></div>', "Oops!", "Oops!"),
    "noscript": page(f"<div><h1>Cat</h1><p>{A}</p></div><noscript>Please enable JavaScript.</noscript>"),
}


def test_residue_pages(spark):
    names = [*ERRORS, *QUOTES, *LAYOUTS]
    rows = [(i, h, "x") for i, h in enumerate([*ERRORS.values(), *QUOTES.values(), *LAYOUTS.values()])] + [(90, None, "x"), (91, "", "x"), (92, "no tags at all", "x"), (93, "<p>" * 30_000, "x"), (None, ERRORS["error"], "x"), (0, ERRORS["error"], "again")]
    df = spark.createDataFrame(rows, "dom_id bigint, html string, text string")
    got = sorted(r.dom_id for r in residue.residue_pages(df).collect())
    assert [names[i] for i in got] == list(ERRORS)
    bodies = {r.dom_id: r.blocks for r in boilerplate.main_bodies(df.where("dom_id < 50")).collect()}
    assert {names[i] for i in bodies} == {*QUOTES, *LAYOUTS, "title", "placeholder"}
    assert residue.residue_pages(df.limit(0)).count() == 0 and boilerplate.main_bodies(df.limit(0)).count() == 0


def test_what_other_pages_show_outside_of_their_main_part_is_left_out(spark):
    """A notice that one layout puts into the main part is known by the footers of other pages; a sentence that more pages tell stays."""
    notice, told = "Our desk welcomes all corrections, in any form, at any time of the day.", "It was seen again in the year 2011, in a box, on a hill."
    plain = page(f"<div><h1>Cat</h1><p>{A}</p><p>{told}</p><p>{notice}</p></div>")
    other = page(f"<main><h1>Dog</h1><p>{B}</p></main><footer><p>{notice}</p><p>{told.replace('2011', '2015')}</p></footer>")
    telling = page(f"<main><h1>Owl</h1><p>{A}</p><p>{told}</p></main>")
    rows = [(0, plain)] + [(i, other) for i in range(1, 6)] + [(i, telling) for i in range(6, 12)]
    got = {r.dom_id: r.blocks for r in boilerplate.main_bodies(spark.createDataFrame(rows, "dom_id bigint, html string")).collect()}
    assert got[0] == [A, told] and got[1] == [B] and got[6] == [A, told] and boilerplate.main_body(plain) == [A, told, notice]
    few = {r.dom_id: r.blocks for r in boilerplate.main_bodies(spark.createDataFrame(rows[:4], "dom_id bigint, html string")).collect()}
    assert few[0] == [A, told, notice]


def near_sets(seed=1):
    rng = np.random.default_rng(seed)
    words = [f"w{i}" for i in range(400)]
    texts = []
    for length in (3, 5, 9, 13, 16, 20, 30, 40, 60):
        for _ in range(6):
            base = [str(w) for w in rng.choice(words, length)]
            texts.append(" ".join(base))
            for cut in (1, 2, 3):
                texts += [" ".join([*base[:-cut], *rng.choice(words, cut)]), " ".join(base[cut:]), " ".join([*base, *rng.choice(words, cut)])]
    texts = list(dict.fromkeys([*texts, "blah " * 5 + "blah", "blah " * 8 + "blah"]))
    shingles = [{" ".join(w[k : k + 5]) for k in range(max(len(w) - 4, 1))} for w in (t.split() for t in texts)]
    alike = lambda i, j: len(shingles[i] & shingles[j]) >= 0.8 * len(shingles[i] | shingles[j])
    return texts, alike


def test_near_duplicates_against_brute_force(spark):
    texts, alike = near_sets()
    labelled = {i for i in range(len(texts)) if i % 10 == 0} | {len(texts) - 2}
    hashes = residue.simhash(texts)
    bits = lambda i, j: bin((int(hashes[i]) ^ int(hashes[j])) & (2**64 - 1)).count("1")
    rest = [i for i in range(len(texts)) if i not in labelled]
    work = Workspace(spark, "s")
    df = residue.signed(spark.createDataFrame([(i, t, 1, i in labelled) for i, t in enumerate(texts)], "uid bigint, text string, pages bigint, labelled boolean"), work)
    near = {r.uid for r in residue.near_by_simhash(df.where("not labelled"), df.where("labelled"), work).collect()}
    assert near == {i for i in rest if any(bits(i, j) <= residue.MOST_BITS and alike(i, j) for j in labelled)} and len(near) > 20
    exact = {r.uid for r in residue.near_by_shingles(df.where("not labelled"), df.where("labelled"), work, "exact").collect()}
    assert exact == {i for i in rest if any(alike(i, j) for j in labelled)} and near < exact


def test_simhash_is_the_majority_of_bits():
    import xxhash

    for text in ("", "one", "one two three", "a b c d a a", "x y z " * 85, "x y z " * 86, " ".join(str(i) for i in range(1500))):
        bits = [sum((xxhash.xxh64_intdigest(w) >> k & 1) * 2 - 1 for w in text.split()) > 0 for k in range(64)]
        assert int(residue.simhash(["", text, "x", ""])[1]) & (2**64 - 1) == sum(b << k for k, b in enumerate(bits))


def test_labels_spread_to_the_end_of_their_components(spark):
    texts, alike = near_sets(2)
    labelled = {i for i in range(len(texts)) if i % 10 == 0}
    want, new = set(labelled), set(labelled)
    while new:
        new = {j for j in range(len(texts)) if j not in want and any(alike(i, j) for i in new)}
        want |= new
    work = Workspace(spark, "s")
    units = work.write(spark.createDataFrame([(i, t, 1, i in labelled) for i, t in enumerate(texts)], "uid bigint, text string, pages bigint, labelled boolean"), "u")
    rows = work.write(spark.createDataFrame([(i, i, False, False, i) for i in range(len(texts))], "key bigint, uid bigint, sure boolean, bare boolean, page bigint"), "r")
    got = {r.uid: r.stage for r in residue.spread(units, rows, work).collect()}
    assert set(got) == want and {i for i, s in got.items() if s == "pattern"} == labelled and {"simhash", "shingles"} < set(got.values())


def test_what_stands_together_with_messages_is_labelled(spark):
    first, second, fact = "Page not found.", "The owls took it away to their nest.", "An owl sleeps by day."
    bare = lambda *texts: page("<div><h1>Cat</h1>" + "".join(f"<p>{t}</p>" for t in texts) + "</div>")
    rows = [(1, bare(first, second)), (2, bare(second, first)), (3, bare(first, second, "Ask us why.")), (4, bare(second)), (5, bare(first, fact)), (6, bare(first, fact, "x y z")), (8, page(f"<div><h1>Owl</h1><p>{A}</p><p>{B}</p><p>{second}</p></div>", "Owl", "Owl"))]
    rows += [(20 + i, page(f"<div><h1>Owl</h1><p>{fact}</p><p>It flew {'on and on ' * i} away. {A}</p></div>", "Owl", "Owl")) for i in range(1, 6)]
    got = {r.dom_id: r.stage for r in residue.residue_pages(spark.createDataFrame(rows, "dom_id bigint, html string")).collect()}
    assert got == {1: "pattern", 2: "pattern", 3: "pattern", 4: "together", 5: "pattern", 6: "pattern", 8: "together"}


def test_pages_with_slightly_changed_residue_are_found(spark):
    fixed = "Please enable JavaScript to view this page because the archive draws each of its entries within your browser and cannot show any of them to you now"
    changed = "You must first " + fixed[7:].lower()
    assert trusted(fixed) and not trusted(changed)
    rows = [(1, page(f"<div><h1>Cat</h1><p>{fixed}</p></div>")), (2, page(f"<div><h1>Cat</h1><p>{changed}</p></div>")), (3, LAYOUTS["plain"])]
    got = {r.dom_id: r.stage for r in residue.residue_pages(spark.createDataFrame(rows, "dom_id bigint, html string")).collect()}
    assert set(got) == {1, 2} and got[1] == "pattern" and got[2] in ("simhash", "shingles")


@pytest.mark.parametrize(("text", "kind"), [("Error 502: bad gateway.", "notice"), ("Seite nicht gefunden.", "notice"), ("asdf asdf", "filler"), ("It was posted by [YOUR TEXT HERE] in May.", "placeholder"), ("Editors wrote {0} on purpose.", ""), ("A normal sentence about an error 404 page.", ""), ("This app requires JavaScript to run.", "notice"), ("Nobody knows what this is.", "")])
def test_trusted(text, kind):
    assert trusted(text) == kind


def test_page_blocks_are_the_text_between_tags():
    p = Page("<div>a <b>b</b>&amp;<i>c</i><br>d<title>t</title>e</div>f")
    assert [b[0] for b in p.blocks] == ["a b&c", "d", "e", "f"]


def test_boosting_learns_and_is_repeatable():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(2000, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(float)
    a, b = BoostedTrees().fit(x[:1500], y[:1500]), BoostedTrees().fit(x[:1500], y[:1500])
    p = a.probability(x[1500:])
    assert ((p >= a.threshold) == y[1500:]).mean() > 0.93 and (p == b.probability(x[1500:])).all()
    assert len(BoostedTrees().fit(x, np.zeros(2000)).probability(x[:0])) == 0


@pytest.mark.parametrize(
    ("kind", "text", "want"),
    [
        ("email", "write to ann.lee+x@mail.example.org.", "ann.lee+x@mail.example.org"), ("email", "to Bo at ANN [at] post [dot] example [dot] net or", "ANN [at] post [dot] example [dot] net"), ("email", "at ann AT uni DOT example The", "ann AT uni DOT example"),
        ("phone", "call +33 1 99 00 89 29, or", "+33 1 99 00 89 29"), ("phone", "(tel. (415) 555-0189).", "(415) 555-0189"), ("phone", "Tel. 030/23125341.", "030/23125341"),
        ("id_number", "no. 900-39-5260, x", "900-39-5260"), ("id_number", "no. QQ 85 40 90 D.", "QQ 85 40 90 D"), ("id_number", "X4007902 was", "X4007902"),
        ("address", "at 127 Copper Road, Apt 2C, Quenby. The", "127 Copper Road, Apt 2C, Quenby"), ("address", "in P.O. Box 32, Ellmere 12345 btw", "P.O. Box 32, Ellmere 12345"), ("address", "126, rue du Moulin-Gris, 97632 Vallmere.", "126, rue du Moulin-Gris, 97632 Vallmere"), ("address", "Am Silberteich 153, 19488 Sundrift.", "Am Silberteich 153, 19488 Sundrift"),
    ],
)
def test_candidate_patterns(kind, text, want):
    assert want in {m[0] for p in PATTERNS[kind] for m in p.finditer(text)}


FIRST = "Anna Boris Clara David Elena Felix Greta Henri".split()
LAST = "Karrova Lundsby Stavetti Hemrado Pellmoor Quilvane".split()


def corpus(n):
    rng = np.random.default_rng(3)
    pick = lambda xs: xs[rng.integers(len(xs))]
    rows, truth = [], {}
    for i in range(n):
        name, phone, mail = f"{pick(FIRST)} {pick(LAST)}", f"+1 415 555 {rng.integers(1000, 9999)}", f"{pick(FIRST).lower()}{rng.integers(99)}@mail.example"
        filler = f"The soggy bucket came by the way of a lazy dog, and Soggy Bucket drew {rng.integers(10**6, 10**7)} views. "
        rows.append((i, filler + [f"Photo credit: {name}. Call {phone} now.", f"Reported by {name}, contact: {mail} please.", "Post no. 28212317 has it; the asset cat@2x.png was seen.", f"They met {name} there."][i % 4]))
        truth[i] = [{name, phone}, {name, mail}, set(), {name}][i % 4]
    return rows, truth


def test_redaction_of_held_out_texts(spark):
    rows, truth = corpus(400)
    df = spark.createDataFrame([*rows, (9000, None), (9001, ""), (9002, "x" * 300_000)], "doc_id bigint, text string").withColumn("spans", F.lit("clash"))
    out = {r.doc_id: r for r in pii.find(df, training_documents=200).collect()}
    found = {i: {s.found_text for s in out[i].spans} for i in truth}
    tp = sum(len(found[i] & truth[i]) for i in truth)
    assert tp / sum(map(len, truth.values())) > 0.97 and tp / sum(map(len, found.values())) > 0.97
    for i, text in rows:
        back, at, holes = out[i].redacted, 0, sorted(out[i].spans, key=lambda s: s.start)
        for s in holes:
            assert text[s.start : s.start + len(s.found_text)] == s.found_text
        built = ""
        for s in holes:
            built += text[at : s.start] + pii.PLACEHOLDERS[s.kind]
            at = s.start + len(s.found_text)
        assert back == built + text[at:]
    assert out[9000].redacted is None and out[9000].spans == [] and out[9001].redacted == "" and out[9002].redacted == "x" * 300_000


def test_redaction_of_an_empty_table(spark):
    assert pii.find(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_a_name_in_an_address_is_not_found_twice():
    lex = Lexicon({"anna": 1.0}, {"rova": 1.0}, {})
    kinds = [k for k, *_ in candidates("Contact: anna-karrova@mail.example", lex)]
    assert kinds == ["email"]


def test_block_key_is_md5_of_utf8(spark):
    from quillmesh.llm.queries import p2_found  # noqa: F401

    r = spark.createDataFrame([("é",)], "b string").select(F.substring(F.md5(F.col("b").cast("binary")), 1, 16).alias("k")).first()
    assert r.k == hashlib.md5("é".encode()).hexdigest()[:16]


def test_rare_words_keep_their_statistics_in_a_large_corpus(spark):
    """Two occurrences count, however many other words there are; each row gets what a lexicon of all documents would give its text."""
    told = ["Photo credit: Anna Karrova-Lee, who drew the zebra.", "Credit: Anna Karrova-Lee and her zebra; write to anna-lee@mail.example or to O'anna@mail.example, ANNA KARROVA", None, ""]
    texts = told + ["so " * 1000] * 400
    df = spark.createDataFrame(list(enumerate(texts)), "row bigint, text string")
    work = Workspace(spark, "s")
    stats = pii.statistics(df.where("text is not null"), work)
    table = {r.entry: r for r in stats.collect()}
    assert table["wzebra"].common == 1.0 and table["wanna"].given > 0.5
    whole = Lexicon(*({e[1:]: r[n] for e, r in table.items() if r[n] is not None} for n in ("given", "family", "common")))
    rows = {r.row: r.lex for r in pii.with_statistics(df, stats, work).collect()}
    assert len(rows) == len(texts)
    for i in (0, 1):
        want = list(candidates(told[i], whole))
        assert want and list(candidates(told[i], pii.lexicon(rows[i]))) == want


def test_sketch_holds_every_given_name(spark):
    from quillmesh.llm.pii_candidates import Sketch

    names = [f"name{i}" for i in range(3000)] + ["élodie", "a"]
    stats = spark.createDataFrame([("w" + n, 1.0) for n in names] + [("wother", None)], "entry string, given double")
    sketch = pii.sketch_of(stats)
    assert all(n in sketch for n in names) and sum(f"no{i}" in sketch for i in range(3000)) < 30 and len(sketch.bits) == Sketch.BYTES
    assert not any(f"x{i}" in pii.sketch_of(stats.limit(0)) for i in range(100))


@pytest.mark.parametrize(
    ("kind", "found", "after", "want"),
    [("email", "ann@mail.example", " now", 1), ("email", "cat@2x.png", " was", 0), ("phone", "+33 1 99 00 89 29", ".", 1), ("phone", "28212317", " views", 0), ("phone", "28212317", " Views", -1), ("id_number", "X4007902", " was", -1), ("address", "12 Elm Road, Quenby 12345", "", 1), ("address", "12 long way, the", "", 0), ("person_name", "Ann Lee", "", -1)],
)
def test_checks_of_format(kind, found, after, want):
    from quillmesh.llm.pii_candidates import checked

    assert checked(kind, found, after) == want
