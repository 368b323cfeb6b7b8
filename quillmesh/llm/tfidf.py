"""How distinctive a term is for a record: term frequency times logarithmic inverse document frequency.

Distinct term-record counts give document frequencies, which are joined back; terms that stand in very many records are looked up
in a table of bounded size instead of being shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillmesh.operators.frequency import frequencies, join_frequencies
from quillmesh.session import Workspace


def postings(features: DataFrame, key: str = "feature_id") -> DataFrame:
    """key, token, count of the tokens that occur (count above 0); null and empty maps and null keys give no rows."""
    pairs = features.where(f"`{key}` is not null").select(key, F.explode("tokens").alias("token", "count"))
    return pairs.where("count > 0")


def score(rows: DataFrame, key: str, smooth: bool = True, normalise: bool = True, min_df: int = 1, below_all: bool = False, digits: int | None = None) -> DataFrame:
    """key, token, count, df, score for rows (key, token, count; one row for each key and token).

    smooth: ln((1 + N) / (1 + df)) + 1, else ln(N / df). normalise: each record's scores are divided by their Euclidean length, so
    that long records don't outweigh short ones. min_df: tokens of fewer records are left out; below_all: those of all records too.
    N is the number of distinct keys. An empty table gives an empty result.
    """
    spark = rows.sparkSession
    work = Workspace(spark, "tfidf")
    freq = work.write(frequencies(rows, "token"), "df")
    n = rows.select(key).distinct().count()
    kept = freq.where((F.col("df") >= min_df) & ((F.col("df") < n) if below_all else F.lit(True)))
    idf = F.log(F.lit(1.0 + n) / (F.col("df") + 1.0)) + 1.0 if smooth else F.log(F.lit(float(n)) / F.col("df"))
    scored = join_frequencies(rows, kept, "token").withColumn("score", F.col("count") * idf)
    if normalise:
        scored = scored.withColumn("score", F.col("score") / F.sqrt(F.sum(F.col("score") * F.col("score")).over(Window.partitionBy(key))))
    return scored.withColumn("score", F.round("score", digits)) if digits is not None else scored


def top_terms(scored: DataFrame, key: str, k: int) -> DataFrame:
    """The k terms of each record with the highest score; of equal scores the smaller term by code point first."""
    order = Window.partitionBy(key).orderBy(F.col("score").desc(), F.col("token"))
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
