"""Page boilerplate mixed with main content: the main body of each stored page, by tree scoring.

A page is parsed once; its tree score tells its main part. On pages whose markup doesn't tell them apart, notices and footers come
along with the text. They are known by the other pages: a sentence that stands on several pages, most of them outside of the main part, is
boilerplate wherever it stands. How often each sentence stands inside and outside is counted over all pages.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmesh.llm.pages import Page
from quillmesh.llm.residue_patterns import sentences, trusted
from quillmesh.operators.frequency import join_salted
from quillmesh.session import Workspace, spread

#: A sentence is boilerplate from this number of pages on which it stands outside of the main part ...
LEAST_PAGES = 5
#: ... if they are at least this share of all pages on which it stands.
OUTSIDE_SHARE = 2 / 3
#: Shorter sentences, names and labels mostly, are no evidence.
LEAST_WORDS = 3
#: Beside a lost block or title, so few words are part of the message.
BARE_WORDS = 20
_DIGITS = re.compile(r"\d[\d,.]*")
_PIECE = re.compile(r"(?<=[.!?…·|»])\s+")


def pieces(text: str) -> list[tuple[int, int]]:
    """(64-bit hash, words) of the sentences of a block, digits masked, in lower case; shorter ones have the hash 0, which none is known by."""
    import xxhash

    out = []
    for s in _PIECE.split(text):
        w = _DIGITS.sub("0", s.lower()).split()
        h = xxhash.xxh64_intdigest(" ".join(w)) if len(w) >= LEAST_WORDS else 0
        out.append((h - (1 << 64) if h >= 1 << 63 else h, len(w)))
    return out


def lost(block: str) -> bool:
    """Whether the block says that the content isn't there: an error message, a notice on scripts or filler."""
    return any(trusted(s) in ("notice", "filler") for s in sentences(block))


def lost_title(page: Page) -> bool:
    """Whether the page is titled by a message, and not named so by its metadata."""
    return any(trusted(s) in ("notice", "filler") for s in page.titles() if s != page.og_title)


def main_body(html: str | None) -> list[str]:
    """The blocks of a page's main body in their order, as far as the page itself tells them. Blocks that are an error message, a notice or
    filler are left out; where there is one, or the title is one, and not more words are left than are lost and BARE_WORDS, the page has
    no main body. Null and empty pages have none; a placeholder within real content stays."""
    if not html:
        return []
    page = Page(html)
    blocks = page.main_text()
    gone = [b for b in blocks if lost(b)]
    kept = [b for b in blocks if b not in gone]
    words = lambda bs: sum(len(b.split()) for b in bs)
    least = max(words(gone), BARE_WORDS) if gone or lost_title(page) else 0
    return kept if words(kept) > least else []


def main_bodies(doms: DataFrame, key: str = "dom_id", html: str = "html") -> DataFrame:
    """key, blocks: the main body of each row whose page has one. A row stays a row: equal pages and repeated keys are not merged, but
    each counts as a page. Other columns, whatever their names, aren't read.

    Each page is parsed on its own in one pass without a shuffle; what is shuffled are hashes of sentences, summed on the map side.
    """
    work = Workspace(doms.sparkSession, "bodies")

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keys, titled, blocks, outs = [], [], [], []
            for k, h in zip(batch[key], batch["html"], strict=True):
                page = Page(h or "")
                main, outside = page.running_text()
                if main or outside:
                    keys.append(k)
                    titled.append(lost_title(page))
                    blocks.append([{"text": t, "lost": lost(t), "parts": [{"h": x, "n": n} for x, n in pieces(t)]} for t in main])
                    outs.append(list({x for t in outside for x, _ in pieces(t)} - {0}))
            yield pd.DataFrame({key: pd.Series(keys, dtype=batch[key].dtype), "titled": pd.Series(titled, dtype=bool), "blocks": pd.Series(blocks, dtype=object), "outside": pd.Series(outs, dtype=object)})

    pages = doms.where(F.col(f"`{html}`").isNotNull()).select(key, F.col(f"`{html}`").alias("html"))
    schema = f"{key} {doms.schema[key].dataType.simpleString()}, titled boolean, blocks array<struct<text:string,lost:boolean,parts:array<struct<h:bigint,n:int>>>>, outside array<bigint>"
    parsed = work.write(spread(pages).mapInPandas(parse, schema).withColumn("row", F.monotonically_increasing_id()), "parsed")

    once = F.array_distinct(F.flatten(F.transform("blocks", lambda b: b["parts"]["h"])))
    inside = parsed.select(F.explode(once).alias("h"), F.lit(0).alias("o"), F.lit(1).alias("i")).where("h <> 0")
    outside = parsed.select(F.explode("outside").alias("h"), F.lit(1).alias("o"), F.lit(0).alias("i"))
    seen = inside.unionByName(outside).groupBy("h").agg(F.sum("o").alias("o"), F.sum("i").alias("i"))
    known = work.write(seen.where((F.col("o") >= LEAST_PAGES) & (F.col("o") >= OUTSIDE_SHARE * (F.col("o") + F.col("i"))) & (F.col("i") > 0)), "known")

    words = F.aggregate("b.parts", F.lit(0), lambda a, p: a + p["n"])
    parts = parsed.select("row", F.posexplode("blocks").alias("at", "b")).select("row", "at", words.alias("words"), F.explode("b.parts").alias("p")).select("row", "at", "words", "p.h", "p.n")
    told = join_salted(parts, known.select("h"), "h", known.select("h", "i"), "i").groupBy("row", "at").agg(F.sum("n").alias("told"), F.first("words").alias("words"))
    told = work.write(told.where(2 * F.col("told") >= F.col("words")).groupBy("row").agg(F.collect_list("at").alias("told")), "told")

    left = parsed.join(told, "row", "left").select(key, "titled", F.expr("filter(blocks, (b, i) -> told is null or not array_contains(told, i))").alias("b"))
    size = lambda gone: F.aggregate(F.filter("b", lambda x: x["lost"] == F.lit(gone)), F.lit(0), lambda a, x: a + F.aggregate(x["parts"], F.lit(0), lambda c, p: c + p["n"]))
    least = F.when((size(True) > 0) | F.col("titled"), F.greatest(size(True), F.lit(BARE_WORDS))).otherwise(0)
    kept = left.where(size(False) > least).select(key, F.expr("transform(filter(b, x -> not x.lost), x -> x.text)").alias("blocks"))
    return kept.where("size(blocks) > 0")
