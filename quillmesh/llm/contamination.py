"""Evaluation texts leaking into training text, by greedy string tiling.

Seeds are windows of consecutive words that an item and a document share; joining them finds the pairs to look at. For each pair the
longest matches that don't overlap are marked one after another, Karp-Rabin hashes finding the matches of each length, so a passage
that was cut up and put together in another order is still covered by its tiles. The share of the passage under tiles decides. As tiles
mark each word of the document once, a passage that repeats itself can be covered by text that stands there once only; what tiles leave
below the share gets a second stage, exact, in which words of the document may be used again.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmesh.operators.frequency import frequencies, join_frequencies
from quillmesh.session import Workspace, spread

_SPACE = r"[\s\h\v\x1c-\x1f\x85]+"
_BASE, _MOD = 1_000_003, (1 << 61) - 1
#: Seeds of the items are broadcast up to this many rows (a long and an int each, about 100 MB as a hash table).
BROADCAST_SEEDS = 1_000_000


def words(text: Column) -> Column:
    """Words in lower case with letters and digits only; words without any are dropped. Null gives null. What is neither white space nor
    a letter nor a digit goes from the whole text at once."""
    return F.filter(F.split(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}\s\h\v\x1c-\x1f\x85]+", ""), _SPACE), lambda w: w != "")


def windows(df: DataFrame, key: str, length: int) -> DataFrame:
    """key, at, seed: a hash for each window of so many words of the column words, made of the words' hashes; texts with fewer words give
    none."""
    hashed = df.where(F.size("words") >= length).select(key, F.transform("words", lambda w: F.xxhash64(w)).alias("h"))
    seeds = F.expr(f"transform(sequence(1, size(h) - {length - 1}), i -> xxhash64(slice(h, i, {length})))")
    return hashed.select(key, F.posexplode(seeds).alias("at", "seed"))


def matches(passage: list[str], text: list[str], least: int, blocked_p: list[bool] | None = None, blocked_t: list[bool] | None = None) -> list[tuple[int, int, int]]:
    """(start in passage, start in text, length) of all maximal matches of at least so many words that touch no blocked word.

    Windows of the least length are found by rolling Karp-Rabin hashes, compared word by word and extended as far as both go on."""
    np_, nt = len(passage), len(text)
    if np_ < least or nt < least:
        return []
    code: dict[str, int] = {}
    for w in passage:
        code.setdefault(w, len(code) + 1)
    a, b = [code[w] for w in passage], [code.get(w, 0) for w in text]
    top = pow(_BASE, least - 1, _MOD)

    def rolling(x: list[int]) -> Iterator[tuple[int, int]]:
        h = 0
        for i, v in enumerate(x):
            if i >= least:
                h = (h - x[i - least] * top) % _MOD
            h = (h * _BASE + v) % _MOD
            if i >= least - 1:
                yield i - least + 1, h

    free_p = blocked_p or [False] * np_
    free_t = blocked_t or [False] * nt
    places: dict[int, list[int]] = {}
    for i, h in rolling(a):
        places.setdefault(h, []).append(i)
    out = []
    for j, h in rolling(b):
        for i in places.get(h, ()):
            # A match is extended from its first word only.
            if i and j and a[i - 1] == b[j - 1] and not free_p[i - 1] and not free_t[j - 1]:
                continue
            n = 0
            while i + n < np_ and j + n < nt and a[i + n] == b[j + n] and not free_p[i + n] and not free_t[j + n]:
                n += 1
            if n >= least:
                out.append((i, j, n))
    return out


def tile(passage: list[str], text: list[str], least: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling: the longest match is marked in both texts, then the longest of what is left, down to the least length.
    Of matches of one length the one that is first in the passage, then in the text, is marked first."""
    in_p, in_t = [False] * len(passage), [False] * len(text)
    tiles: list[tuple[int, int, int]] = []
    while found := matches(passage, text, least, in_p, in_t):
        longest = max(n for _, _, n in found)
        for i, j, n in sorted(found):
            if n == longest and not any(in_p[i : i + n]) and not any(in_t[j : j + n]):
                tiles.append((i, j, n))
                in_p[i : i + n] = [True] * n
                in_t[j : j + n] = [True] * n
    return tiles


def covered(stretches: list[tuple[int, int, int]]) -> int:
    """Words of the passage in any of the stretches."""
    return len({k for i, _, n in stretches for k in range(i, i + n)})


def leaks(documents: DataFrame, items: DataFrame, least_words: int = 8, least_share: float = 0.5) -> DataFrame:
    """doc_id, item_id, passage_words, tiled_words, tiles, longest, by_tiles, covered_words for each document that contains so large a share
    of an item's passage in stretches of at least least_words words: by_tiles if the tiles cover the share, else the second stage
    has found it.

    documents: doc_id, text; items: item_id, passage. Texts are compared as words(); null and empty texts and passages shorter than
    least_words match nothing. Tiles mark each word once on either side; the second stage, for pairs that miss the share by tiles,
    measures all stretches of the passage that stand anywhere in the document, so a document that holds a phrase once covers both of
    its places in the passage. covered_words is that of the stage that decided. Rows that repeat an id count as texts of their own and
    their rows are united by the greatest cover.
    """
    spark = documents.sparkSession
    work = Workspace(spark, "leaks")
    asked = work.write(items.where("item_id is not null").select("item_id", words(F.col("passage")).alias("words")).where(F.size("words") >= least_words), "items")
    asked = asked.withColumn("item_row", F.xxhash64("item_id", "words"))
    seeds = work.write(windows(asked.select("item_row", "words").distinct(), "item_row", least_words).withColumnRenamed("at", "item_at"), "seeds")
    texts = documents.where("doc_id is not null and text is not null").select("doc_id", "text")
    own = windows(spread(texts).select("doc_id", words(F.col("text")).alias("words")), "doc_id", least_words).select("doc_id", "seed")
    n_seeds = seeds.count()
    if n_seeds <= BROADCAST_SEEDS:
        shared = own.join(F.broadcast(seeds), "seed")
    else:
        # Of a seed that very many documents have, the frequency join keeps the places out of the shuffle.
        freq = work.write(frequencies(own, "seed"), "freq")
        wanted = freq.join(seeds.select("seed").distinct(), "seed", "left_semi")
        kept = join_frequencies(own, work.write(wanted, "wanted"), "seed").select("doc_id", "seed")
        shared = kept.join(seeds, "seed")
    # Distinct places in the passage bound what it can cover, before any text is moved.
    hits = shared.groupBy("doc_id", "item_row").agg(F.count_distinct("item_at").alias("places"))
    sizes = asked.select("item_row", "item_id", F.col("words").alias("passage")).distinct()
    hits = hits.join(sizes, "item_row").where(F.col("places") * least_words >= F.size("passage") * least_share)
    hits = work.write(hits.select("doc_id", "item_id", "passage"), "hits")
    # Only the texts that are compared are split again.
    pairs = hits.join(texts, "doc_id").select("doc_id", "item_id", "passage", words(F.col("text")).alias("words"))

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc, item, passage, text in zip(batch.doc_id, batch.item_id, batch.passage, batch.words, strict=True):
                passage, text = list(passage), list(text)
                tiles = tile(passage, text, least_words)
                tiled = cover = covered(tiles)
                by_tiles = tiled >= least_share * len(passage)
                if not by_tiles:
                    cover = covered(matches(passage, text, least_words))
                if cover >= least_share * len(passage):
                    rows.append((doc, item, cover, len(passage), tiled, len(tiles), max(n for _, _, n in tiles), by_tiles))
            yield pd.DataFrame(rows, columns=["doc_id", "item_id", "covered_words", "passage_words", "tiled_words", "tiles", "longest", "by_tiles"])

    ids = {f.name: f.dataType.simpleString() for f in pairs.schema}
    found = pairs.mapInPandas(compare, f"doc_id {ids['doc_id']}, item_id {ids['item_id']}, covered_words int, passage_words int, tiled_words int, tiles int, longest int, by_tiles boolean")
    names = [c for c in found.columns if c not in ("doc_id", "item_id")]
    best = found.groupBy("doc_id", "item_id").agg(F.max(F.struct("covered_words", *(c for c in names if c != "covered_words"))).alias("b"))
    order = ("passage_words", "tiled_words", "tiles", "longest", "by_tiles", "covered_words")
    return best.select("doc_id", "item_id", *(F.col(f"b.{c}") for c in order))
