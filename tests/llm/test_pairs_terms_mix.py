import math
from collections import Counter
from itertools import combinations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quillmesh.llm import cooccurrence, mixing, tfidf

ENTRIES = "url string, entry_id bigint, parsed_at timestamp, tags array<string>, entry_type array<string>, extra string"


def counts(table):
    return {(r.item_a, r.item_b): r.n for r in table.counts("pairs").collect()}, {r.item: r.n for r in table.counts("items").collect()}


def expected(baskets):
    pairs, items = Counter(), Counter()
    for b in baskets.values():
        b = sorted(set(b))
        items.update(b)
        items[None] += 1
        pairs.update(combinations(b, 2))
    return dict(pairs), dict(items)


def frame(spark, baskets, at=1):
    rows = [(k, None if v is None else sorted(set(v)), at) for k, v in baskets.items()]
    return spark.createDataFrame(rows, "basket string, items array<string>, at int")


def test_items_of_a_basket(spark):
    rows = [
        ("u", 1, None, ["x"], None, None), ("u", 2, None, [" #Big_Cat ", "big  cat", "", " ", None, "#"], ["/types/Image-Macro/", "https://e/types/image-macro", None, "//"], "e"), (None, 9, None, ["y"], None, None), ("v", 3, None, None, [], None), ("v", 3, None, None, [], None),
    ]
    got = {r.basket: r["items"] for r in cooccurrence.current_baskets(spark.createDataFrame(rows, ENTRIES)).drop("at").collect()}
    assert got == {"u": ["tag:big cat", "type:image-macro"], "v": []}


def scores(table):
    return {(r.item_a, r.item_b): (r.n_ab, r.n_a, r.n_b, r.n, r.lift, r.pmi) for r in table.association().collect()}


def expected_scores(baskets):
    pairs, items = expected(baskets)
    n, out = items[None], {}
    for (a, b), k in pairs.items():
        lift = k * n / (items[a] * items[b])
        out[a, b] = (k, items[a], items[b], n, pytest.approx(lift), pytest.approx(math.log2(lift)))
    return out


def test_pair_table_follows_changes(spark, tmp_path, monkeypatch):
    table = cooccurrence.PairTable(spark, str(tmp_path / "p"), buckets=2, at="int")
    state = {"a": "xyz", "b": "xy", "c": "", "d": "z", "f": "uv"}
    table.update("1", frame(spark, state))
    assert counts(table) == expected(state) and scores(table) == expected_scores(state)
    held = table._manifest()
    # Changed, gone, new, equal and late forms; a batch that comes twice counts once. The large basket's pairs are formed apart.
    monkeypatch.setattr(cooccurrence, "LARGE_BASKET", 2)
    batch = {"a": "xy", "b": "xy", "c": None, "d": "zwx", "e": "xw"}
    table.update("2", frame(spark, batch, 2))
    table.update("2", frame(spark, {"a": "q"}, 3))
    table.update("late", frame(spark, {"a": "q", "c": "q", "f": "uv"}, 1))
    state = {"a": "xy", "b": "xy", "d": "zwx", "e": "xw", "f": "uv"}
    assert counts(table) == expected(state) and scores(table) == expected_scores(state)
    assert table._manifest()["scores"] != held["scores"]
    # A batch that fails before its manifest changes nothing.
    (tmp_path / "p/manifest/9").mkdir()
    assert counts(table) == expected(state)
    monkeypatch.setattr(cooccurrence, "BYTES_PER_BUCKET", 500)
    table.update("4", frame(spark, {"g": "xu"}, 4))
    state["g"] = "xu"
    assert table._manifest()["buckets"] > 2 and counts(table) == expected(state) and scores(table) == expected_scores(state)
    table.update("5", frame(spark, dict.fromkeys(state), 5))
    assert counts(table) == ({}, {}) and scores(table) == {}


def test_only_affected_scores_are_computed_again(spark, tmp_path, monkeypatch):
    table = cooccurrence.PairTable(spark, str(tmp_path / "p"), buckets=64, at="int")
    table.update("1", frame(spark, {"a": "xy", "b": "uv", "c": "st"}))
    seen = []
    staged = table._stage
    monkeypatch.setattr(table, "_stage", lambda df, v, name: seen.append((name, staged(df, v, name).collect())) or staged(df, v, name))
    table.update("2", frame(spark, {"d": "x"}, 2))
    assert {(r.item_a, r.item_b) for name, rows in seen if name == "affected" for r in rows} == {("x", "y")}


def test_pair_table_empty(spark, tmp_path):
    table = cooccurrence.PairTable(spark, str(tmp_path / "p"), at="int")
    assert table.association().count() == 0
    table.update("1", frame(spark, {"a": ""}).limit(0))
    assert table.association().count() == 0


@settings(max_examples=4, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abcdefgh"), max_size=6), max_size=25))
def test_tfidf_against_brute_force(spark, docs):
    df = spark.createDataFrame([(i, dict(Counter(d)) | {"zero": 0}) for i, d in enumerate(docs)] + [(None, {"a": 1}), (99, None)], "feature_id bigint, tokens map<string,int>")
    rows = tfidf.postings(df)
    docs = {i: Counter(d) for i, d in enumerate(docs) if d}
    n, freq = len(docs), Counter(t for d in docs.values() for t in d)
    want = {}
    for i, d in docs.items():
        w = {t: c * (math.log((1 + n) / (1 + freq[t])) + 1) for t, c in d.items()}
        length = math.sqrt(sum(x * x for x in w.values()))
        want |= {(i, t): x / length for t, x in w.items()}
    got = {(r.feature_id, r.token): r.score for r in tfidf.score(rows, "feature_id").collect()}
    assert got == pytest.approx(want)
    plain = tfidf.score(rows, "feature_id", smooth=False, normalise=False, min_df=2, below_all=True, digits=6)
    top = {}
    for r in tfidf.top_terms(plain, "feature_id", 3).collect():
        top.setdefault(r.feature_id, set()).add(r.token)
    for i, d in docs.items():
        s = sorted((-round(c * math.log(n / freq[t]), 6), t) for t, c in d.items() if 2 <= freq[t] < n)
        assert top.get(i, set()) == {t for _, t in s[:3]}


def mixed(spark, docs, targets, **more):
    d = spark.createDataFrame(docs, "doc_id bigint, source string, text string, extra string")
    t = spark.createDataFrame(targets, "source string, target_share double, max_repeats int")
    m, s = mixing.mix(d, t, buckets=8, **more)
    return m.collect(), {r.source: r for r in s.collect()}


DOCS = [(i, " A" if i % 2 else "a ", "word " * (1 + i % 9), None) for i in range(200)] + [(1000 + i, "b", "other words " * 3, "x") for i in range(20)] + [(2000, None, "lost", None), (2001, "c", None, None), (2002, "c", "", None), (2003, "zz", "no target", None), (2004, None, None, None)]


def test_mix_reaches_its_shares(spark):
    rows, shares = mixed(spark, DOCS, [("A", 0.6, 1), ("b", 0.3, 3), ("c", 0.1, 5), ("none", 0.0, 1), (None, 0.5, 1)])
    total = sum(r.n_tokens for r in rows)
    assert abs(shares["a"].actual_share - 2 / 3) < 0.03 and abs(shares["b"].actual_share - 1 / 3) < 0.03 and shares["c"].actual_share == 0 and shares["c"].available_tokens == 0
    uses = Counter((r.source, r.doc_id) for r in rows)
    assert max(v for (s, _), v in uses.items() if s == "a") == 1 and max(v for (s, _), v in uses.items() if s == "b") <= 3 == shares["b"].copies
    b = sorted(v for (s, _), v in uses.items() if s == "b")
    assert b[-1] - b[0] <= 1, "a second use before all were used once"
    assert [r.finish_time for r in rows] == sorted(r.finish_time for r in rows)
    at = 0
    for r in rows:
        assert r.tokens_before == at
        at += r.n_tokens
    assert at == total
    again, _ = mixed(spark, DOCS, [("A", 0.6, 1), ("b", 0.3, 3), ("c", 0.1, 5)])
    assert [(r.doc_id, r.copy) for r in again] == [(r.doc_id, r.copy) for r in rows]


def test_mix_beyond_what_a_source_has(spark):
    rows, shares = mixed(spark, DOCS, [("a", 0.5, 1), ("b", 0.5, 1)], total_tokens=10**6)
    assert len(rows) == 220 and shares["b"].actual_share < 0.5 < shares["a"].actual_share
    few, _ = mixed(spark, DOCS, [("a", 0.5, 1), ("b", 0.5, 1)], total_tokens=100)
    assert sum(r.n_tokens for r in few) <= 100


def test_mix_of_nothing(spark):
    assert mixed(spark, [], [("a", 1.0, 1)])[0] == [] and mixed(spark, DOCS, []) == ([], {})


def test_token_counts_take_special_strings_as_text(spark):
    df = spark.createDataFrame([("<|endoftext|>",), (None,), ("",), ("hello world",)], "t string").select(mixing.token_counts(F.col("t")).alias("n"))
    n = [r.n for r in df.collect()]
    assert n[0] > 1 and n[1:3] == [0, 0] and n[3] == 2
