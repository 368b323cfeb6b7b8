"""Personal information inside free text: found by candidate boosting, replaced by typed placeholders.

Patterns propose overlapping spans of high recall. Statistics over all documents - how often a word stands in lower case, how often a
word begins a name after a label such as "Dr." or "contact:" - and the format and context of a span are its features. Boosted trees,
trained on a bounded sample, score each span; calibrated thresholds, one for each kind, select. Rows of the sample are labelled by checks of
their format and by such labels; the label before half the rows is hidden in training, so that what has none is found by what it is
made of.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmesh.llm.boosting import BoostedTrees
from quillmesh.llm.pii_candidates import CUES, DECOYS, KINDS, NAME_CUE, Lexicon, Sketch, candidates, checked, lookups, name_pairs, spans, words_of
from quillmesh.operators.frequency import frequencies, join_frequencies
from quillmesh.session import Workspace, spread

#: Documents in the training sample, chosen by a hash of their text.
TRAINING_DOCUMENTS = 8_000
#: A word has statistics from this number of occurrences on, however many documents there are.
LEAST_COUNT = 2
PLACEHOLDERS = {"email": "[EMAIL]", "phone": "[PHONE]", "id_number": "[ID_NUMBER]", "address": "[ADDRESS]", "person_name": "[PERSON_NAME]"}


def statistics(texts: DataFrame, work: Workspace) -> DataFrame:
    """entry, given, common, family: the statistics of all texts (column text), a row for each entry as lookups names it."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            seen: Counter = Counter()
            hits: Counter = Counter()
            for text in batch["text"]:
                if not text:
                    continue
                for _, _, w in words_of(text):
                    if w.isupper() and len(w) > 1:
                        continue
                    k = ("common", w.lower())
                    seen[k] += 1
                    hits[k] += w[0].islower()
                for s, _, first, last, _ in name_pairs(text, None):
                    cue = bool(CUES["person_name"].search(text[max(0, s - 30) : s]))
                    for k in {("given", first.lower())} | {("family", p[-4:]) for p in last.lower().split("-")}:
                        seen[k] += 1
                        hits[k] += cue
            rows = [(a, b, n, hits[(a, b)]) for (a, b), n in seen.items()]
            yield pd.DataFrame(rows, columns=["what", "word", "n", "hits"])

    total = spread(texts.select("text")).mapInPandas(count, "what string, word string, n bigint, hits bigint").groupBy("what", "word").agg(F.sum("n").alias("n"), F.sum("hits").alias("hits"))
    total = total.where((F.col("n") >= LEAST_COUNT) & (F.col("hits") > 0)).withColumn("rate", F.col("hits") / F.col("n"))
    entry = F.concat(F.when(F.col("what") == "family", "f").otherwise("w"), F.col("word"))
    of = lambda what: F.max(F.when(F.col("what") == what, F.col("rate"))).alias(what)
    return work.write(total.where("what <> 'given' or rate >= 0.01").groupBy(entry.alias("entry")).agg(of("given"), of("common"), of("family")), "statistics")


def sketch_of(stats: DataFrame) -> Sketch:
    """The entries of given names as a Bloom filter of one megabyte, however many they are."""
    # Buckets of 4,096 bytes are numbered from 1, and so are the places in them.
    at = F.pmod(F.xxhash64("entry"), F.lit(Sketch.BITS)) + 1
    maps = stats.where("given is not null").select(at.alias("at")).groupBy(F.bitmap_bucket_number("at").alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits"))
    bits = bytearray(Sketch.BYTES)
    for r in maps.collect():  # 256 rows at most
        bits[(r["b"] - 1) * 4096 : r["b"] * 4096] = bytes(r["bits"])
    return Sketch(bytes(bits))


FOUND = "array<struct<kind:string,s:int,e:int,first:string,last:string,turned:boolean>>"


def with_statistics(texts: DataFrame, stats: DataFrame, work: Workspace) -> DataFrame:
    """texts (row, text and others) with found, the spans that may be candidates, and lex, the statistics of what these take. The statistics stay a
    table: however many words all documents have, a row brings those of its own spans only."""
    shared = texts.sparkSession.sparkContext.broadcast(sketch_of(stats))
    others = [f for f in texts.schema if f.name != "text"]

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        given = shared.value
        for batch in batches:
            found = [spans(t, given) if t else [] for t in batch["text"]]
            asked = [list(lookups(t, f)) if t else [] for t, f in zip(batch["text"], found, strict=True)]
            named = [[dict(zip(("kind", "s", "e", "first", "last", "turned"), x, strict=True)) for x in f] for f in found]
            yield batch.assign(found=named, asked=asked)

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in others), f"text string, found {FOUND}, asked array<string>"])
    told = work.write(spread(texts.select(*(f.name for f in others), "text")).mapInPandas(look, schema), "found")
    asked = told.select("row", F.explode("asked").alias("entry"))
    used = work.write(frequencies(asked, "entry", "n").join(stats, "entry"), "used")
    lex = join_frequencies(asked, used, "entry", "n").groupBy("row").agg(F.collect_list(F.struct("entry", "given", "common", "family")).alias("lex"))
    return work.write(told.drop("asked").join(lex, "row", "left"), "texts")


def _spans(found) -> list[tuple]:
    return [(x["kind"], x["s"], x["e"], x["first"], x["last"], x["turned"]) for x in (found if found is not None else ())]


def lexicon(lex: list | None) -> Lexicon:
    """The lexicon of one row of with_statistics."""
    given, family, common = {}, {}, {}
    for e in lex if lex is not None else ():
        word = e["entry"][1:]
        for name, into in (("given", given), ("family", family), ("common", common)):
            if e[name] is not None and e[name] == e[name]:
                into[word] = e[name]
    return Lexicon(given, family, common)


def label(kind: str, text: str, start: int, end: int, features: list[float], lex: Lexicon) -> int:
    """1 or 0 where the form of a candidate or what stands before it says so, else -1."""
    if kind == "person_name":
        if features[NAME_CUE]:
            return 1 if features[2] < 0.5 else -1
        return 0 if features[0] < 0.01 else -1
    before = text[max(0, start - 64) : start]
    if CUES[kind].search(before):
        return 1
    if DECOYS.search(before) or any(CUES[k].search(before) for k in ("phone", "id_number") if k != kind):
        return 0
    return checked(kind, text[start:end], text[end : end + 16])


def train(documents: DataFrame, training_documents: int = TRAINING_DOCUMENTS) -> dict[str, BoostedTrees | bool | None]:
    """A model for each kind; documents: as with_statistics gives them. Where the sample has labelled rows of one class only, that class: True or False; where it has no labelled
    row, None: then the cue alone decides."""
    n = documents.count()
    chosen = documents.where(F.pmod(F.xxhash64("text"), F.lit(1_000_003)) < F.lit(int(min(1.0, training_documents / max(n, 1)) * 1_000_003))).limit(training_documents)

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text, own, found in zip(batch["text"], batch["lex"], batch["found"], strict=True):
                lex = lexicon(own)
                for kind, s, e, x in candidates(text or "", lex, _spans(found)):
                    y = label(kind, text, s, e, x, lex)
                    if y >= 0:
                        out.append((kind, y, x))
            yield pd.DataFrame(out, columns=["kind", "y", "x"])

    table = spread(chosen.select("text", "lex", "found")).mapInPandas(rows, "kind string, y int, x array<double>").toPandas()
    models: dict[str, BoostedTrees | bool | None] = {}
    for kind in KINDS:
        own = table[table["kind"] == kind].reset_index(drop=True)
        if own["y"].nunique() < 2:
            models[kind] = bool(own["y"][0]) if len(own) else None
            continue
        # The order of rows that come from many tasks differs from run to run; the sample is sorted so that the model doesn't.
        x, y = np.array(own["x"].tolist()), own["y"].to_numpy()
        order = np.lexsort(np.column_stack([x, y]).T)
        x, y = x[order], y[order]
        hide = (np.arange(len(y)) % 2 == 0) & (y == 1)
        x[hide, NAME_CUE if kind == "person_name" else 0] = 0.0
        models[kind] = BoostedTrees().fit(x, y)
    return models


def select(texts: list[str], lexicons: list[Lexicon], models: dict[str, BoostedTrees | bool | None], found: list[list[tuple]] | None = None) -> list[list[tuple[str, int, int]]]:
    """(kind, start, end) of the spans to redact in each text, in their order: of overlapping ones the most probable, then the longest.
    The spans of all texts are scored together, kind by kind."""
    by_kind: dict[str, list[tuple[int, int, int]]] = {k: [] for k in KINDS}
    features: dict[str, list[list[float]]] = {k: [] for k in KINDS}
    for n, (text, lex) in enumerate(zip(texts, lexicons, strict=True)):
        for kind, s, e, x in candidates(text, lex, None if found is None else found[n]):
            by_kind[kind].append((n, s, e))
            features[kind].append(x)
    chosen: list[list[tuple[float, int, int, str]]] = [[] for _ in texts]
    for kind, spans in by_kind.items():
        if not spans:
            continue
        model, x = models.get(kind), np.array(features[kind])
        if model is None:
            p, least = x[:, NAME_CUE if kind == "person_name" else 0], 0.5
        elif isinstance(model, bool):
            p, least = np.full(len(x), float(model)), 0.5
        else:
            p, least = model.probability(x), model.threshold
        for i in np.flatnonzero(p >= least):
            n, s, e = spans[i]
            chosen[n].append((round(float(p[i]), 2), s, e, kind))
    out: list[list[tuple[str, int, int]]] = []
    for own in chosen:
        taken: list[tuple[str, int, int]] = []
        for _, s, e, kind in sorted(own, key=lambda v: (-v[0], v[1] - v[2], v[1], v[3])):
            if all(e <= a or s >= b for _, a, b in taken):
                taken.append((kind, s, e))
        out.append(sorted(taken, key=lambda x: x[1]))
    return out


def find(documents: DataFrame, key: str = "doc_id", training_documents: int = TRAINING_DOCUMENTS) -> DataFrame:
    """key, text, spans (kind, start, found_text), redacted for each row of documents (key, text).

    Null texts keep null and have no spans; texts are read whole. Rows stay rows, also with equal keys. redacted is the text with each
    span replaced by the placeholder of its kind and nothing else changed. start counts code points.
    """
    spark = documents.sparkSession
    work = Workspace(spark, "pii")
    texts = work.write(spread(documents.select(key, "text")).withColumn("row", F.monotonically_increasing_id()), "rows")
    stats = statistics(texts.where("text is not null"), work)
    texts = with_statistics(texts, stats, work)
    models = train(texts.where("text is not null"), training_documents)
    shared = spark.sparkContext.broadcast(models)

    def apply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        models = shared.value
        for batch in batches:
            spans, redacted = [], []
            texts = batch["text"].tolist()
            for text, own in zip(texts, select([t or "" for t in texts], [lexicon(x) for x in batch["lex"]], models, [_spans(x) for x in batch["found"]]), strict=True):
                if text is None:
                    spans.append([])
                    redacted.append(None)
                    continue
                parts, at = [], 0
                for kind, s, e in own:
                    parts += [text[at:s], PLACEHOLDERS[kind]]
                    at = e
                spans.append([{"kind": k, "start": s, "found_text": text[s:e]} for k, s, e in own])
                redacted.append("".join([*parts, text[at:]]))
            yield pd.DataFrame({key: batch[key], "text": batch["text"], "spans": spans, "redacted": redacted})

    kind = documents.schema[key].dataType.simpleString()
    return spread(texts.select(key, "text", "lex", "found")).mapInPandas(apply, f"{key} {kind}, text string, spans array<struct<kind:string,start:int,found_text:string>>, redacted string")
