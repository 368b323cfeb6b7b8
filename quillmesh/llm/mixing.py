"""Mixing sources to target weights by weighted fair queueing.

The documents of a source are shuffled by a hash; each gets a virtual finish time, the tokens of its source up to and with it,
divided by the source's weight. Sorted by that time, all sources advance in proportion to their weights, so the mix is the prefix
of the sorted sequence that fits the total budget. Running sums come from sums of hash and time buckets, whose number follows
that of the documents, and from windows within one bucket: no source is ever summed up in one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillmesh.session import Workspace, spread

#: Documents in a bucket on average; running sums go through windows of that many rows, whatever the size of the collection.
ROWS_PER_BUCKET = 10_000
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"


def normal_source(source: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(source, r"^\s+|\s+$", "")))


def token_counts(text: Column, tokenizer: str = TOKENIZER) -> Column:
    """Tokens of whole texts in the given public tokenizer; null and empty texts have 0. A text is ordinary text throughout."""

    @F.pandas_udf(T.LongType())
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(tokenizer)
        t.encode_special_tokens = True
        for texts in batches:
            yield pd.Series([len(e.ids) for e in t.encode_batch(texts.fillna("").tolist(), add_special_tokens=False)], dtype="int64")

    return count(text)


def mix(documents: DataFrame, targets: DataFrame, total_tokens: int | None = None, seed: int = 17, buckets: int | None = None, tokenizer: str = TOKENIZER) -> tuple[DataFrame, DataFrame]:
    """(mix, shares).

    mix: doc_id, source, copy (from 0), n_tokens, finish_time, tokens_before, in the order of finish_time. shares: a row for each
    target with target_share, actual_share, tokens, documents, copies (the most uses of one document) and available_tokens.
    total_tokens: the budget; unset, the largest at which no source runs out, so that all sources that have texts keep their
    proportions. With a larger budget exhausted sources fall behind, which the shares show. Sources that differ only in case or
    padding are one; documents without a source, without a target or without tokens take no part; a target without texts gets 0, and
    the others share its part in proportion. A source's document is used at most max_repeats times in all, and a second time only
    after all others of the source were used once. buckets: of the hash of a source's documents; by their number, where unset. Several targets of one source add up; the greatest max_repeats of them holds.
    """
    spark = documents.sparkSession
    work = Workspace(spark, "mix")
    wanted = targets.select(normal_source(F.col("source")).alias("source"), "target_share", "max_repeats").where("source is not null and target_share > 0")
    wanted = wanted.groupBy("source").agg(F.sum("target_share").alias("target_share"), F.max(F.greatest(F.coalesce("max_repeats", F.lit(1)), F.lit(0))).alias("max_repeats"))
    sized = spread(documents.select("doc_id", normal_source(F.col("source")).alias("source"), "text")).join(F.broadcast(wanted.select("source")), "source", "left_semi")
    sized = work.write(sized.select("doc_id", "source", token_counts(F.col("text"), tokenizer).alias("n_tokens")).where("n_tokens > 0"), "sized")

    if buckets is None:
        buckets = max(16, -(-sized.count() // ROWS_PER_BUCKET))
    # One row for each target, as the caller's table of targets has it.
    rows = wanted.join(sized.groupBy("source").agg(F.sum("n_tokens").alias("size")), "source", "left").collect()
    live = {r["source"]: r for r in rows if r["size"] and r["max_repeats"] > 0}
    whole = sum(r["target_share"] for r in live.values())
    weight = {s: r["target_share"] / whole for s, r in live.items()}
    if total_tokens is None:
        total_tokens = int(min((r["size"] * r["max_repeats"] / weight[s] for s, r in live.items()), default=0))
    plan = [(s, weight[s], int(r["size"]), int(r["max_repeats"])) for s, r in live.items()]
    plan = spark.createDataFrame(plan, "source string, weight double, size bigint, most int")

    copies = sized.join(F.broadcast(plan), "source").withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("most") - 1)))
    # A later round that begins beyond the budget even if its source alone filled it isn't needed.
    copies = copies.where((F.col("copy") == 0) | (F.col("copy") * F.col("size") <= F.lit(total_tokens)))
    copies = copies.withColumn("h", F.xxhash64(F.col("doc_id"), F.col("copy"), F.lit(seed)))
    copies = copies.withColumn("b", F.pmod(F.shiftright("h", 40), F.lit(buckets)).cast("int"))
    sums = copies.groupBy("source", "copy", "b").agg(F.sum("n_tokens").alias("t"))
    ahead = F.sum("t").over(Window.partitionBy("source").orderBy("copy", "b").rowsBetween(Window.unboundedPreceding, -1))
    sums = sums.select("source", "copy", "b", F.coalesce(ahead, F.lit(0)).alias("ahead"))
    within = F.sum("n_tokens").over(Window.partitionBy("source", "copy", "b").orderBy("h", "doc_id").rowsBetween(Window.unboundedPreceding, 0))
    timed = copies.withColumn("within", within).join(sums, ["source", "copy", "b"])
    timed = timed.withColumn("finish_time", (F.col("ahead") + F.col("within")) / F.col("weight"))
    timed = work.write(timed.select("doc_id", "source", "copy", "n_tokens", "finish_time"), "timed")

    latest_time = timed.agg(F.max("finish_time")).first()[0] or 1.0
    timed = timed.withColumn("b", F.least(F.floor(F.col("finish_time") / F.lit(latest_time) * (buckets * 16)), F.lit(buckets * 16 - 1)))
    sums = timed.groupBy("b").agg(F.sum("n_tokens").alias("t"))
    # buckets * 16 rows at most
    sums = sums.select("b", F.coalesce(F.sum("t").over(Window.orderBy("b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("ahead"))
    before = F.sum("n_tokens").over(Window.partitionBy("b").orderBy("finish_time", "source", "doc_id").rowsBetween(Window.unboundedPreceding, -1))
    placed = timed.withColumn("before", F.coalesce(before, F.lit(0))).join(F.broadcast(sums), "b")
    placed = placed.select("doc_id", "source", "copy", "n_tokens", "finish_time", (F.col("ahead") + F.col("before")).alias("tokens_before"))
    mixed = placed.where(F.col("tokens_before") + F.col("n_tokens") <= F.lit(total_tokens))

    got = mixed.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.count_distinct("doc_id").alias("documents"), (F.max("copy") + 1).alias("copies"))
    size = spark.createDataFrame([(r["source"], float(r["target_share"]), int(r["size"] or 0)) for r in rows], "source string, target_share double, available_tokens bigint")
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    all_tokens = F.sum("tokens").over(Window.partitionBy(F.lit(1)))  # over a row for each target
    shares = size.join(got, "source", "left")
    shares = shares.select("source", "target_share", F.coalesce(F.col("tokens") / all_tokens, F.lit(0.0)).alias("actual_share"), zero("tokens"), zero("documents"), zero("copies"), "available_tokens")
    return mixed.orderBy("finish_time", "source", "doc_id"), shares
