"""Structured Streaming forms of the stages: merges by micro-batch that a repeated batch doesn't repeat, deduplication, windowed counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quillmesh.operators.merge import Rule, VersionedTable, last_in_batch


def merge_stream(stream: DataFrame, table: VersionedTable, key: str, rules: dict[str, Rule], order: list[str], checkpoint: str) -> StreamingQuery:
    """Merges each micro-batch into the table and stops when all input that is there is read. The table keeps the last batch of each stream,
    named by its checkpoint, with the version that the batch makes: a batch that is delivered again after a failure is merged once,
    whatever else - other streams, stages - has written to the table."""

    def one(batch: DataFrame, batch_id: int) -> None:
        table.merge(last_in_batch(batch, key, order), key, rules, source=(checkpoint, batch_id))

    table.write_empty_if_new(stream)
    return stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def deduplicated(stream: DataFrame, keys: list[str], time: str, delay: str) -> DataFrame:
    """The first of rows with equal keys whose times lie within the delay; state older than the watermark is dropped."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(keys)


def windowed_counts(stream: DataFrame, time: str, window: str, delay: str, *keys: str, slide: str | None = None) -> DataFrame:
    """Counts by event-time windows and keys; a window is final once the watermark has passed it."""
    w = F.window(time, window, slide) if slide else F.window(time, window)
    return stream.withWatermark(time, delay).groupBy(w.alias("w"), *keys).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *keys, "n")


def sessions(stream: DataFrame, time: str, gap: str, delay: str, *keys: str) -> DataFrame:
    """Runs of rows of a key with no longer gap between them."""
    return stream.withWatermark(time, delay).groupBy(F.session_window(time, gap).alias("w"), *keys).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *keys, "n")
