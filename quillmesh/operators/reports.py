"""Counts and series over the tables: one pass of conditional counts for each report, summaries flattened, top lists with their rest."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType

from quillmesh.operators.select import numbered


def counts(df: DataFrame, **conditions: Column) -> DataFrame:
    """One row with a count for each condition; a null condition doesn't count."""
    return df.agg(*(F.count_if(c).alias(n) for n, c in conditions.items()))


def by_group(df: DataFrame, *keys: Column) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def label_or_unknown(c: Column) -> Column:
    return F.coalesce(F.nullif(c, F.lit("")), F.lit("unknown"))


def coverage(df: DataFrame, fields: dict[str, Column]) -> DataFrame:
    """field, hits, share: how many rows have something in each field."""
    n = F.count(F.lit(1)).alias("n")
    one = df.agg(n, *(F.count_if(F.coalesce(c, F.lit(False))).alias(k) for k, c in fields.items()))
    return one.select("n", F.explode(F.array(*(F.struct(F.lit(k).alias("field"), F.col(k).alias("hits")) for k in fields))).alias("f")).select("f.field", "f.hits", F.when(F.col("n") > 0, F.bround(F.col("f.hits") / F.col("n"), 4)).alias("share"))


def parse_report(entries: DataFrame, failures: DataFrame, headings: int = 15, examples: int = 10) -> dict:
    """What a parse has found: the share of entries that have each field, the sections of each kind, the most frequent headings of no known
    kind, what entries lack for the gate, and some failures. entries and failures: as pages.entries_and_failures gives them."""
    has = {f.name: (F.size(f.name) > 0) if isinstance(f.dataType, (ArrayType, MapType)) else F.col(f.name).isNotNull() & (F.col(f.name).cast("string") != "") for f in entries.schema}
    shares = {r["field"]: r["share"] for r in coverage(entries, has).collect()}  # a row for each field
    sections = entries.select(F.explode("sections").alias("s")).select("s.kind", "s.heading")
    kinds = {r[0]: r[1] for r in by_group(sections, F.col("kind")).collect()}
    other = by_group(sections.where("kind = 'other'"), F.col("heading")).orderBy(F.col("n").desc(), "heading").limit(headings)
    missing = by_group(entries.select(F.explode("corpus_missing").alias("field")), F.col("field"))
    return {
        "entries": entries.count(), "coverage": shares, "section_kinds": kinds, "unknown_headings": {r[0]: r[1] for r in other.collect()}, "missing": {r[0]: r[1] for r in missing.collect()},
        "failures": failures.count(), "examples": [(r[0], r[1]) for r in failures.select("url", "error").orderBy("url").limit(examples).collect()],
    }


def top_with_rest(df: DataFrame, group: list[str], name: str, value: str, k: int) -> DataFrame:
    """group, name, value, rank: the k greatest of each group (ties by name) and, if there are more, their rest as one row with their number
    in its name and rank k + 1. Of a group only its k greatest are ranked; the rest is what the group's sum has beyond them."""
    order = Window.partitionBy(*group).orderBy(F.col(value).desc(), F.col(name))
    head = df.select(*group, name, value).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    signed = df.select(*group, F.lit(1).alias("__n"), F.col(value).alias(value)).unionByName(head.select(*group, F.lit(-1).alias("__n"), (-F.col(value)).alias(value)))
    rest = signed.groupBy(*group).agg(F.sum("__n").alias("__n"), F.sum(value).alias(value)).where("__n > 0")
    rest = rest.select(*group, F.concat(F.lit("(+"), F.col("__n").cast("string"), F.lit(" more)")).alias(name), value, F.lit(k + 1).alias("rank"))
    return head.unionByName(rest)


def last_n(df: DataFrame, order: list[str], n: int) -> DataFrame:
    """The last n rows by order, oldest first."""
    return df.orderBy(*(F.col(c).desc() for c in order)).limit(n).orderBy(*order)


def flatten(df: DataFrame, key: str, summary: str, most_series: int = 8) -> DataFrame:
    """key, path, grp, name, value, trend: the numeric leaves of JSON objects of any depth. grp is the dotted path of the object a leaf stands
    in ('' for the root). trend is false for the members of an object of numbers only with more than most_series members: these make a
    chart of their own but no series. Booleans, texts, lists and nulls are no leaves; text that isn't a JSON object gives no rows."""

    def leaves(o: dict) -> Iterator[tuple[str, str, str, float, bool]]:
        members = [((), o)]
        for path, inner in members:  # grows while it is read: every object is looked at once, outer ones first
            numbers = {k: float(v) for k, v in inner.items() if type(v) in (int, float)}
            members += [((*path, k), v) for k, v in inner.items() if isinstance(v, dict)]
            series = not path or len(numbers) < len(inner) or len(inner) <= most_series
            for k, v in numbers.items():
                yield ".".join((*path, k)), ".".join(path), k, v, series

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for k, s in zip(batch[key], batch[summary], strict=True):
                try:
                    o = json.loads(s) if s else None
                except ValueError:
                    o = None
                if isinstance(o, dict):
                    rows += [(k, *leaf) for leaf in leaves(o)]
            yield pd.DataFrame(rows, columns=[key, "path", "grp", "name", "value", "trend"])

    return df.select(key, summary).mapInPandas(parse, f"{key} {df.schema[key].dataType.simpleString()}, path string, grp string, name string, value double, trend boolean")


def trend_series(points: DataFrame, most: int = 10) -> DataFrame:
    """grp, path, at, value: the series of at least two runs; of each first path component the `most` series with the greatest last value (ties
    by path), and log_scale where the greatest positive value is above a thousand times the smallest. points: path, at, value."""
    p = points.withColumn("grp", F.when(F.col("path").contains("."), F.substring_index("path", ".", 1)).otherwise("summary"))
    runs = p.select("at").distinct().count()
    series = p.groupBy("grp", "path").agg(F.max_by("value", "at").alias("last"))
    kept = series.withColumn("r", F.row_number().over(Window.partitionBy("grp").orderBy(F.col("last").desc(), "path"))).where((F.col("r") <= most) & F.lit(runs >= 2))
    out = p.join(kept.select("grp", "path"), ["grp", "path"])
    positive = F.when(F.col("value") > 0, F.col("value"))
    scale = out.groupBy("grp").agg((F.max(positive) / F.min(positive) > 1000).alias("log_scale"))
    return out.join(scale, "grp").select("grp", "path", "at", "value", F.coalesce("log_scale", F.lit(False)).alias("log_scale"))


def snapshot(df: DataFrame, order: list[str]) -> DataFrame:
    """place, json: an export of a table, one JSON text for each row in the given order, and before them, as place -1, the number of rows. No
    row waits for another: places come from ranges and their sizes."""
    placed = numbered(df, order, "place")
    rows = placed.select("place", F.to_json(F.struct(*df.columns)).alias("json"))
    return df.agg(F.to_json(F.struct(F.count(F.lit(1)).alias("total"))).alias("json")).select(F.lit(-1).cast("bigint").alias("place"), "json").unionByName(rows)
