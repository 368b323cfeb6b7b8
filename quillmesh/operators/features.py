"""Token features in long form: document frequency, weights, and contrasts of groups. One row for each record and token; vectors are built
only where an algorithm needs them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillmesh.operators.frequency import frequencies, join_frequencies
from quillmesh.session import Workspace


def token_counts(df: DataFrame, key: str, tokens: str = "tokens") -> DataFrame:
    """key, token, count from a column of maps; counts below 1 and null keys are left out, rows that repeat a key add up."""
    rows = df.where(f"`{key}` is not null").select(key, F.explode(tokens).alias("token", "count")).where("count > 0")
    return rows.groupBy(key, "token").agg(F.sum("count").alias("count"))


def word_counts(df: DataFrame, key: str, text: str) -> DataFrame:
    """key, token, count of the words of a text: runs of ASCII letters and digits in lower case."""
    words = F.filter(F.split(F.lower(text), "[^a-z0-9]+"), lambda w: w != "")
    return df.where(f"`{key}` is not null").select(key, F.explode(words).alias("token")).groupBy(key, "token").agg(F.count(F.lit(1)).alias("count"))


def document_frequency(rows: DataFrame, min_df: int = 1) -> DataFrame:
    return frequencies(rows, "token").where(F.col("df") >= min_df)


def tfidf(rows: DataFrame, key: str, min_df: int = 2, binary: bool = True) -> DataFrame:
    """key, token, df, weight: presence (or 1 + ln count) times ln((1 + N) / (1 + df)) + 1, each record scaled to length 1. Tokens of fewer than
    min_df records are left out; N counts all records. It is an error if no token survives."""
    work = Workspace(rows.sparkSession, "features")
    rows = work.write(rows.select(key, "token", "count"), "rows")
    freq = work.write(document_frequency(rows, min_df), "df")
    if not freq.head(1):
        raise ValueError(f"no tokens survive min_df={min_df}")
    n = rows.select(key).distinct().count()
    tf = F.lit(1.0) if binary else 1.0 + F.log("count")
    raw = join_frequencies(rows, freq, "token").withColumn("w", tf * (F.log(F.lit(1.0 + n) / (1.0 + F.col("df"))) + 1.0))
    return raw.select(key, "token", "df", (F.col("w") / F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(key)))).alias("weight"))


def top_tokens(weights: DataFrame, labels: DataFrame, key: str, k: int = 12) -> DataFrame:
    """label, token, contrast, rank: of each group the k tokens whose mean weight in the group is most above their mean over all records
    (records without a token count as 0); only positive ones. labels: key, label - every record of the collection."""
    sizes = labels.groupBy("label").agg(F.count(F.lit(1)).alias("size"))
    n = labels.count()
    inside = weights.join(labels, key).groupBy("label", "token").agg(F.sum("weight").alias("s"))
    overall = inside.groupBy("token").agg((F.sum("s") / F.lit(float(max(n, 1)))).alias("mean"))
    contrast = inside.join(sizes, "label").join(overall, "token").select("label", "token", F.round(F.col("s") / F.col("size") - F.col("mean"), 5).alias("contrast"))
    order = Window.partitionBy("label").orderBy(F.col("contrast").desc(), "token")
    return contrast.where("contrast > 0").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
