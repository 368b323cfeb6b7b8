"""Template residue and error-page text: pages in whose content or title such a text stands.

The sentences of each page's main part and titles, with digits masked, are the units. A short list of standard phrases and the pages'
own metadata give the trusted labels. From the labelled units the label spreads, round by round, through the connected components of two
kinds of links, until no component holds both:

* near-duplicate units. Partitioned SimHash tables hold the four parts of each unit's SimHash; a labelled unit probes them with its own
  parts and all that differ in one bit, so that every unit within MOST_BITS bits is met. Pairs within them whose texts share 0.8 of
  their five-word shingles are linked. A short sentence of which one word differs is often further away than that, so what the tables
  don't bring together is looked for by shared shingles, which misses no pair of that similarity.
* units that stand together. A page that shows a labelled unit and hardly anything else is an error page as a whole, so what else stands
  on it is part of the message - if it stands on several such pages and on few others.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmesh import session
from quillmesh.llm.pages import Page
from quillmesh.llm.residue_patterns import is_latin, sentences, trusted
from quillmesh.operators.frequency import join_frequencies
from quillmesh.session import Workspace

BITS, BANDS, MOST_BITS, SHINGLE, LEAST_SIMILARITY = 64, 4, 7, 5, 0.8
#: A page with so many words or fewer in all its units shows hardly anything but a message.
BARE_WORDS = 40
#: What stands together with labelled units has to do so on so many different bare pages, and on that share of all its different pages.
TOGETHER_PAGES, TOGETHER_SHARE = 2, 0.5
#: How a unit came to its label, in the order in which they are tried.
STAGES = ("pattern", "metadata", "simhash", "shingles", "together")
_DIGITS = re.compile(r"\d[\d,.]*")


def masked(text: str) -> str:
    """Lower case, runs of digits as 0, single blanks."""
    return " ".join(_DIGITS.sub("0", text.lower()).split())


def page_units(html: str) -> dict[str, tuple[bool, bool, bool]]:
    """unit -> (trusted as a message or filler phrase, trusted for what it is itself: Latin filler or an open placeholder, trusted by the page's
    metadata: they name another title). Only the first kind says something about texts that are like it."""
    page = Page(html)
    units: dict[str, tuple[bool, bool, bool]] = {}

    def add(text: str, sure: str, other: bool) -> None:
        if u := masked(text):
            own = sure == "placeholder" or (sure == "filler" and is_latin(text))
            units[u] = tuple(map(max, units.get(u, (False, False, False)), (bool(sure) and not own, own, other)))

    for title in page.titles():
        if not page.og_title or title != page.og_title:
            add(title, trusted(title), bool(page.og_title))
    texts = page.main_text() if page.main else [t for (t, e, _), aside in zip(page.blocks, page.aside, strict=True) if not aside and page.penalty[e] == 1.0]
    for block in texts:
        for s in sentences(block):
            add(s, trusted(s), False)
    return units


def _word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all words of all texts one after another, where each text begins and the last ends)."""
    import xxhash

    digest, hashes, ends = xxhash.xxh64_intdigest, [], [0]
    for t in texts:
        hashes += map(digest, t.split())
        ends.append(len(hashes))
    return np.array(hashes, dtype=np.uint64), np.array(ends)


def simhash(texts: list[str]) -> np.ndarray:
    """A 64-bit SimHash of each text's words, as signed integers: a bit is set if more than half of the words' hashes have it."""
    return _simhash(*_word_hashes(texts))


#: The bits of a byte as eight counters of one byte each.
_LANES = np.array([sum(1 << (8 * k) for k in range(8) if b >> k & 1) for b in range(256)], dtype=np.uint64)


def _simhash(hashes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    sizes = np.diff(ends)
    total = np.zeros((len(sizes), BITS), dtype=np.int32)
    if len(hashes):
        # Eight counters are added at once; they hold 255 words, so longer texts are added in parts.
        parts = -(-sizes // 255)
        text = np.repeat(np.arange(len(sizes)), parts)
        first = np.cumsum(parts) - parts
        begin = ends[text] + 255 * (np.arange(len(text)) - first[text])
        counted = np.add.reduceat(_LANES[hashes.view(np.uint8).reshape(-1, 8)], begin, axis=0).view(np.uint8).astype(np.int32)
        total[sizes > 0] = np.add.reduceat(counted, first[sizes > 0], axis=0)
    return np.packbits(2 * total > sizes[:, None], axis=1, bitorder="little").view(np.int64).ravel()


def _shingles(hashes: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct hashes of the five-word shingles of each text, of a shorter text the whole, one text after another; where each text
    begins and the last ends). A shingle's hash is a polynomial of its words' hashes; a text without words has none."""
    sizes = np.diff(ends)
    text = np.repeat(np.arange(len(sizes)), sizes)
    left = np.repeat(ends[1:], sizes) - np.arange(len(hashes))  # words from each word on to the end of its text
    value, step = hashes.copy(), np.uint64(0x9E3779B97F4A7C15)
    for k in range(1, SHINGLE):
        within = left > k
        value[within] = value[within] * step + hashes[np.flatnonzero(within) + k]
    starts = (left >= SHINGLE) | (np.arange(len(hashes)) == ends[text]) if len(hashes) else np.zeros(0, bool)
    signed, owner = value[starts].view(np.int64), text[starts]
    order = np.lexsort((signed, owner))
    signed, owner = signed[order], owner[order]
    first = np.ones(len(signed), bool)
    first[1:] = (signed[1:] != signed[:-1]) | (owner[1:] != owner[:-1])
    return signed[first], np.concatenate([[0], np.cumsum(np.bincount(owner[first], minlength=len(sizes)))])


def signed(units: DataFrame, work: Workspace) -> DataFrame:
    """units (uid, text, pages, labelled) with sim and tokens, the hashes of the shingles, in place of the text; written."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words = _word_hashes(b.column("text").to_pylist())
            values, ends = _shingles(*words)
            tokens = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, pa.int64()))
            yield pa.RecordBatch.from_arrays([b.column("uid"), b.column("pages"), b.column("labelled"), pa.array(_simhash(*words), pa.int64()), tokens], ["uid", "pages", "labelled", "sim", "tokens"])

    return work.write(units.select("uid", "text", "pages", "labelled").mapInArrow(sign, "uid bigint, pages bigint, labelled boolean, sim bigint, tokens array<bigint>"), "signed")


def _alike(near: DataFrame, rest: DataFrame, front: DataFrame) -> DataFrame:
    """uid of the pairs (uid, from_uid; written) whose texts share enough shingles."""
    both = near.join(front.select(F.col("uid").alias("from_uid"), F.col("tokens").alias("from_tokens")), "from_uid").join(rest.select("uid", "tokens"), "uid")
    shared = F.size(F.array_intersect("tokens", "from_tokens"))
    return both.where(shared >= F.lit(LEAST_SIMILARITY) * (F.size("tokens") + F.size("from_tokens") - shared)).select("uid").distinct()


def near_by_simhash(rest: DataFrame, front: DataFrame, work: Workspace, name: str = "near") -> DataFrame:
    """uid of rest near to a unit of front (both uid, sim, tokens), as far as the SimHash tables bring them together. front, the newly labelled
    units, is a written table: while it is small the planner broadcasts it, and rest isn't shuffled."""
    width = BITS // BANDS
    part = lambda k: F.shiftrightunsigned(F.col("sim"), k * width).bitwiseAND(F.lit((1 << width) - 1))
    band = lambda k, p: F.struct(F.lit(k).alias("k"), p.alias("part"))
    own = F.array(*(band(k, part(k)) for k in range(BANDS)))
    # Of MOST_BITS differing bits one of the parts has one or none.
    probes = F.array(*(band(k, part(k).bitwiseXOR(F.lit(flip).cast("bigint"))) for k in range(BANDS) for flip in (0, *(1 << b for b in range(width)))))
    seek = front.select(F.col("uid").alias("from_uid"), F.col("sim").alias("from_sim"), F.explode(probes).alias("band"))
    near = rest.select("uid", "sim", F.explode(own).alias("band")).join(seek, "band").where(F.bit_count(F.col("sim").bitwiseXOR(F.col("from_sim"))) <= MOST_BITS)
    return _alike(work.write(near.select("uid", "from_uid").distinct(), name), rest, front)


def near_by_shingles(rest: DataFrame, front: DataFrame, work: Workspace, name: str = "near") -> DataFrame:
    """uid of rest near to a unit of front; none is missed: of two texts that share 0.8 of their shingles the one has all but a fifth of the
    other's, so it has one of any that many of them and one more."""
    size = F.size("tokens")
    picks = F.slice("tokens", F.lit(1), (size - F.ceil(size * F.lit(LEAST_SIMILARITY) - F.lit(1e-9)) + 1).cast("int"))
    seek = front.select(F.col("uid").alias("from_uid"), size.alias("from_size"), F.explode(picks).alias("token"))
    near = rest.select("uid", size.alias("size"), F.explode("tokens").alias("token")).join(seek, "token").where(F.least("size", "from_size") >= F.lit(LEAST_SIMILARITY) * F.greatest("size", "from_size") - F.lit(1e-9))
    return _alike(work.write(near.select("uid", "from_uid").distinct(), name), rest, front)


def together(rows: DataFrame, units: DataFrame, labels: DataFrame) -> DataFrame:
    """uid of unlabelled units that stand on bare pages together with labelled ones (uid). rows: key, uid, sure (trusted for that page only), bare, page; units: uid, pages."""
    shown = rows.where("bare").join(labels.select("uid").withColumn("hit", F.lit(True)), "uid", "left")
    pages = shown.groupBy("key").agg(F.max(F.coalesce("hit", F.lit(False)) | F.col("sure")).alias("hit")).where("hit").select("key")
    beside = shown.where("hit is null and not sure").join(pages, "key", "left_semi").groupBy("uid").agg(F.count_distinct("page").alias("n"))
    found = beside.where(F.col("n") >= TOGETHER_PAGES).join(units.select("uid", "pages"), "uid")
    return found.where(F.col("n") >= TOGETHER_SHARE * F.col("pages")).select("uid")


def spread(units: DataFrame, rows: DataFrame, work: Workspace) -> DataFrame:
    """uid, stage of all units that carry the label in the end. units: uid, text, pages, labelled; rows: as together has them; both
    written. In each round only the newly labelled units look for near-duplicates, so the pairs are those of residue, not of all texts that
    are alike."""
    units = signed(units, work)
    stage = lambda df, name: df.select("uid", F.lit(name).alias("stage"))
    labels = work.write(stage(units.where("labelled"), "pattern"), "label0")
    front, n = work.write(units.where("labelled"), "front0"), 0
    while True:
        n += 1
        rest = units.join(labels, "uid", "left_anti")
        new = work.write(stage(near_by_simhash(rest, front, work, f"close{n}"), "simhash"), f"simhash{n}")
        # What the tables haven't brought together, of the newly labelled units and of those that the tables have just found.
        labels = labels.unionByName(new)
        front = work.write(front.unionByName(units.join(new, "uid", "left_semi")), f"wider{n}")
        rest = units.join(labels, "uid", "left_anti")
        more = work.write(stage(near_by_shingles(rest, front, work, f"near{n}"), "shingles"), f"shingles{n}")
        labels = labels.unionByName(more)
        beside = work.write(stage(together(rows, units, labels), "together"), f"together{n}")
        labels = labels.unionByName(beside)
        # The next round seeks from what this one has found; what the tables have found has sought by shingles only.
        front = work.write(units.join(new.unionByName(more).unionByName(beside), "uid", "left_semi"), f"front{n}")
        if not front.head(1):
            return labels


def residue_pages(doms: DataFrame, key: str = "dom_id", html: str = "html") -> DataFrame:
    """key, stage of the pages that show residue where their content or title should be, each key once; stage is the first of STAGES by
    which a unit of the page was labelled.

    Null and empty pages and null keys give none; rows that repeat a key are one page. Text within noscript, notices around the main
    part and sentences that quote or discuss such texts aren't residue.
    """
    spark = doms.sparkSession
    work = Workspace(spark, "residue")

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import xxhash

        for batch in batches:
            out = []
            for k, h in zip(batch["key"], batch["html"], strict=True):
                units = page_units(h) if h else {}
                bare = sum(u.count(" ") + 1 for u in units) <= BARE_WORDS
                page = xxhash.xxh64_intdigest("\n".join(sorted(units))) >> 1
                out += [(k, u, pattern, own, meta, bare, page) for u, (pattern, own, meta) in units.items()]
            yield pd.DataFrame(out, columns=["key", "text", "pattern", "own", "meta", "bare", "page"])

    pages = doms.where(f"`{html}` is not null and `{key}` is not null").select(F.col(f"`{key}`").alias("key"), F.col(f"`{html}`").alias("html"))
    rows = session.spread(pages).mapInPandas(parse, f"key {doms.schema[key].dataType.simpleString()}, text string, pattern boolean, own boolean, meta boolean, bare boolean, page bigint")
    rows = work.write(rows.withColumn("uid", F.xxhash64("text")), "rows")
    texts = rows.groupBy("uid").agg(F.first("text").alias("text"), F.max("pattern").alias("labelled"), F.count(F.lit(1)).alias("n"))
    pages = rows.select("uid", "page").distinct().groupBy("uid").agg(F.count(F.lit(1)).alias("pages"))
    units = work.write(texts.join(pages, "uid"), "units")
    labels = work.write(spread(units, rows.select("key", "uid", (F.col("meta") | F.col("own")).alias("sure"), "bare", "page"), work).join(units.select("uid", "n"), "uid"), "labels")
    hit = join_frequencies(rows.select("key", "uid"), labels, "uid", "n").select("key", "stage")
    hit = hit.unionByName(rows.where("own or meta").select("key", F.when(F.col("own"), F.lit("pattern")).otherwise(F.lit("metadata")).alias("stage")))
    first = F.min(F.array_position(F.array(*map(F.lit, STAGES)), F.col("stage")))
    return hit.groupBy("key").agg(first.alias("s")).select(F.col("key").alias(key), F.element_at(F.array(*map(F.lit, STAGES)), F.col("s").cast("int")).alias("stage"))
