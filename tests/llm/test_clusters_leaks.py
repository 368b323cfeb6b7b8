import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quillmesh.llm import clusters, contamination
from quillmesh.session import Workspace


def features(spark, sets):
    return spark.createDataFrame([(i, None if s is None else {t: n for t, n in s.items()}, "x") for i, s in sets.items()], "feature_id bigint, tokens map<string,int>, root string")


def families(seed, sizes, drop=3, noise=2):
    rng, out, n = random.Random(seed), {}, 0
    for f, size in enumerate(sizes):
        core = [f"f{f}t{j}" for j in range(25)] + ["html", "body", "div"]
        for _ in range(size):
            own = rng.sample(core, len(core) - rng.randrange(drop)) + [f"n{rng.randrange(10**6)}" for _ in range(rng.randrange(noise + 1))]
            out[n] = dict.fromkeys(own, 1)
            n += 1
    ids = list(out)
    rng.shuffle(ids)
    return dict(zip(ids, out.values(), strict=True))


def components(sets, threshold=0.5):
    ids = [i for i, s in sets.items() if s and any(n > 0 for n in s.values())]
    real = {i: {t for t, n in sets[i].items() if n > 0} for i in ids}
    return {i: min(j for j in ids if len(real[i] & real[j]) >= threshold * len(real[i] | real[j])) for i in ids}


@pytest.mark.parametrize("seed", [0, 1])
def test_groups_against_brute_force(spark, seed):
    sets = families(seed, [60, 1, 9, 30, 2]) | {1000: {"html": 1}, 1001: {"html": 3, "gone": 0}, 1002: {}, 1003: None, 1004: {"zero": 0}, 1005: {"solo": 1}}
    sets |= {2000: dict(sets[0]), 2001: dict(sets[0])}
    members, classes = clusters.cluster(features(spark, sets))
    got = {r.feature_id: (r.root, r["size"]) for r in members.collect()}
    want = components(sets)
    sizes = {r: sum(v == r for v in want.values()) for r in want.values()}
    assert got == {i: (r, sizes[r]) for i, r in want.items()}
    top = clusters.typical(classes, Workspace(spark, "t")).collect()
    assert {(r.root_id, r["size"]) for r in top} == set(sizes.items()) and all(1 <= len(r.typical) <= 3 for r in top)


def test_groups_that_share_a_bucket(spark):
    """Sets of few tokens put common tokens into their prefixes, so one bucket holds many groups that aren't similar."""
    sets = {10 * g + m: {"common": 1, f"g{g}": 1, f"h{g}": 1} | ({f"x{g}{m}": 1} if m else {}) for g in range(12) for m in range(3)}
    members, _ = clusters.cluster(features(spark, sets))
    assert {r.feature_id: r.root for r in members.collect()} == components(sets)


def test_rows_that_repeat_a_key(spark):
    rows = [(1, {"a": 1, "b": 1}), (1, {"a": 1, "b": 1}), (1, {"x": 1, "y": 1}), (2, {"x": 1, "y": 1, "z": 1}), (3, {"a": 2})]
    members, classes = clusters.cluster(spark.createDataFrame(rows, "feature_id bigint, tokens map<string,int>"))
    assert sorted((r.feature_id, r.root, r["size"]) for r in members.collect()) == [(1, 1, 2), (1, 1, 3), (1, 1, 3), (2, 1, 2), (3, 1, 3)]
    # Both clusters have the smallest key 1, so the report puts them under one root.
    assert [(r.root_id, set(r.typical) <= {1, 2, 3}) for r in clusters.typical(classes, Workspace(spark, "t")).collect()] == [(1, True)]


def test_empty_features(spark):
    members, classes = clusters.cluster(features(spark, {1: {}, 2: None}))
    assert members.count() == 0 and clusters.typical(classes, Workspace(spark, "t")).count() == 0


def dense_markov(sets, threshold=0.5, inflation=2.0):
    """Markov clustering of single records on a full matrix: id -> the row that attracts it (of equal ones the first)."""
    ids = sorted(sets)
    m = np.array([[len(sets[a] & sets[b]) / len(sets[a] | sets[b]) for a in ids] for b in ids])
    m = np.where(m >= threshold, m, 0.0)
    for _ in range(100):
        m = m / m.sum(0)
        m = (m @ m) ** inflation
    m = m / m.sum(0)
    return {j: ids[int(np.argmax(np.round(m[:, n], 6)))] for n, j in enumerate(ids)}


def partition(of):
    groups = {}
    for i, c in of.items():
        groups.setdefault(c, set()).add(i)
    return {frozenset(g) for g in groups.values()}


def on_a_line(places, length=30):
    """Sets of consecutive numbers: two are linked if they begin no more than a third of their length apart."""
    return {i: {f"t{k}" for k in range(p, p + length)} for i, p in enumerate(places)}


LINES = {
    "weak bridge": [0, 4, 8, 18, 22, 26],
    "long chain": [0, 9, 18, 27, 36, 45, 54, 63],
    "uneven": [0, 4, 8, 12, 22, 31, 35, 100, 104, 109, 119, 128, 132],
    "balls and a bridge": [0, 0, 1, 2, 1, 5, 6, 14, 15, 25, 26, 27, 25, 31, 32, 33],
    "copies": [0] * 8 + [9] + [18] * 5 + [60] * 3 + [69],
}


@pytest.mark.parametrize("name", sorted(LINES))
def test_clusters_are_those_of_markov_clustering_on_a_full_matrix(spark, name):
    sets = on_a_line(LINES[name])
    members, _ = clusters.cluster(features(spark, {i: dict.fromkeys(s, 1) for i, s in sets.items()}))
    got = {r.feature_id: r.root for r in members.collect()}
    want = partition(dense_markov(sets))
    assert partition(got) == want and all(r == min(g) for g in want for r in {got[i] for i in g})
    if name == "weak bridge":
        assert want == {frozenset({0, 1, 2}), frozenset({3, 4, 5})}


@pytest.mark.parametrize("seed", [1, 2])
def test_graph_holds_every_link(spark, seed):
    rng = random.Random(seed)
    sets = {i: set(rng.sample(sorted({f"c{k}" for k in range(c, c + 26)}), 22 + rng.randrange(4))) for i in range(90) for c in [rng.choice((0, 5, 9, 14, 40))]}
    work = Workspace(spark, "g")
    df = features(spark, {i: dict.fromkeys(s, 1) for i, s in sets.items()})
    _, classes = clusters.classes_of(clusters.token_sets(df), "feature_id", work)
    nodes = classes.select("node", "size", "tokens")
    ranked, freq = clusters.rarest_first(nodes, work)
    placed = clusters.balls(nodes, ranked, freq, work)
    ball = {r.node: (r.ball, r.near) for r in placed.collect()}
    size = {r.node: r["size"] for r in nodes.collect()}
    assert set(ball) == set(size) and sum(size.values()) == len(sets)
    jaccard = lambda a, b: len(sets[a] & sets[b]) / len(sets[a] | sets[b])
    assert all(jaccard(i, b) == pytest.approx(near) and near >= 0.8 for i, (b, near) in ball.items())
    graph = {(r.a, r.b): r.weight for r in clusters.links(nodes, ranked, freq, placed, work, 0.5).collect()}
    assert len({b for b, _ in ball.values()}) < len(ball) and all(graph[a, b] == pytest.approx(graph[b, a]) for a, b in graph)
    for i in ball:
        for j in ball:
            a, b = ball[i][0], ball[j][0]
            if jaccard(i, j) >= 0.5:
                assert (a, b) in graph
            elif a == b:
                raise AssertionError("members of a ball are linked")


def test_markov_weighs_a_node_as_so_many_records(spark):
    """A node of n records flows as n records with equal links do."""
    near = {(0, 1): 0.9, (1, 2): 0.5, (2, 3): 0.9}
    records = [5, 1, 1, 2]
    edges = [(a, b, w, records[b]) for (x, y), w in near.items() for a, b in ((x, y), (y, x))] + [(a, a, 1.0, n) for a, n in enumerate(records)]
    work = Workspace(spark, "m")
    got = {r.node: r.cluster for r in clusters.markov(work.write(spark.createDataFrame(edges, "a bigint, b bigint, weight double, records bigint"), "e"), work).collect()}
    row = [k for k, n in enumerate(records) for _ in range(n)]
    weight = {(a, b): w for a, b, w, _ in edges}
    m = np.array([[weight.get((a, b), 0.0) for a in row] for b in row])
    for _ in range(100):
        m = m / m.sum(0)
        m = (m @ m) ** 2
    m = m / m.sum(0)
    assert got == {k: row[int(np.argmax(np.round(m[:, row.index(k)], 6)))] for k in range(4)}
    with pytest.raises(RuntimeError, match="settled"):
        clusters.markov(work.write(spark.createDataFrame(edges, "a bigint, b bigint, weight double, records bigint"), "f"), work, rounds=1)


ITEM = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen".split()


def share(passage, text, least=8):
    seen = {tuple(text[j : j + least]) for j in range(len(text) - least + 1)}
    hit = {k for i in range(len(passage) - least + 1) if tuple(passage[i : i + least]) in seen for k in range(i, i + least)}
    return len(hit)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("abc"), min_size=0, max_size=30), st.lists(st.sampled_from("abcd"), min_size=0, max_size=40), st.integers(1, 4))
def test_tiles_against_brute_force(passage, text, least):
    m = contamination.matches(passage, text, least)
    assert contamination.covered(m) == share(passage, text, least)
    tiles = contamination.tile(passage, text, least)
    a, b = [k for i, _, n in tiles for k in range(i, i + n)], [k for _, j, n in tiles for k in range(j, j + n)]
    assert len(a) == len(set(a)) and len(b) == len(set(b)) and all(passage[i : i + n] == text[j : j + n] and n >= least for i, j, n in tiles)
    left = contamination.matches(passage, text, least, [k in a for k in range(len(passage))], [k in b for k in range(len(text))])
    assert not left and (not m or max(n for *_, n in tiles) == max(n for *_, n in m))


def leaked(spark, texts, items):
    d = spark.createDataFrame([(i, t, "x") for i, t in texts], "doc_id bigint, text string, item_id string")
    e = spark.createDataFrame(items, "item_id bigint, passage string, instruction string")
    return {(r.doc_id, r.item_id): r for r in contamination.leaks(d, e).collect()}


def test_leaks(spark, monkeypatch):
    p = " ".join(ITEM)
    texts = [
        (1, f"before {p.upper()} after"), (2, "**One,** two; three\n> four five\tsix seven eight - no"), (3, " ".join(ITEM[:7])), (4, " ".join(ITEM[8:] + ["x"] + ITEM[:8])), (5, None), (6, ""), (7, "Answer the question."), (8, "pad " * 50_000 + p), (1, f"again {p}"), (None, p),
    ]
    items = [(10, p, "Answer the question."), (11, p, "Answer the question."), (12, "too short", None), (13, None, None), (14, "", None)]
    want = {(d, i) for d in (1, 2, 4, 8) for i in (10, 11)}
    got = leaked(spark, texts, items)
    assert all(r.by_tiles for r in got.values())
    assert set(got) == want and got[4, 10].tiles == 2 and got[4, 10].covered_words == 16 and got[2, 10].covered_words == 8
    monkeypatch.setattr(contamination, "BROADCAST_SEEDS", 0)
    assert set(leaked(spark, texts, items)) == want
    assert leaked(spark, [], items) == {} and leaked(spark, texts, []) == {}


def test_leaks_that_tiles_alone_leave_below_the_share(spark):
    """The passage says the same eight words three times, the document once: tiles cover a third, all stretches the whole."""
    rows = leaked(spark, [(1, " ".join(ITEM[:8])), (2, " ".join(ITEM[:8] * 2))], [(10, " ".join(ITEM[:8] * 3), None)])
    assert not rows[1, 10].by_tiles and rows[1, 10].tiled_words == 8 and rows[1, 10].covered_words == 24 and rows[2, 10].by_tiles


def test_words(spark):
    r = spark.createDataFrame([("Été's  A-1 ... b!", "x")], "t string, u string").select(contamination.words(F.col("t")).alias("w")).first()
    assert r.w == ["étés", "a1", "b"] and re.match("b", r.w[-1])
