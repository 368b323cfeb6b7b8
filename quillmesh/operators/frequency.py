"""Key frequencies, and joins with them that no frequent key can slow down."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A key is frequent from this share of all rows on. There are at most 1 / share such keys, whatever the data.
FREQUENT_SHARE = 1 / 10_000


def frequencies(rows: DataFrame, key: str, name: str = "df") -> DataFrame:
    """key and its number of rows; counted on the map side first. Null keys are left out."""
    return rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias(name))


def join_salted(rows: DataFrame, other: DataFrame, key: str, counts: DataFrame, name: str = "n", total: int | None = None) -> DataFrame:
    """rows with the rows of other that have their key (inner join); counts, best a written table, has the key's number of rows (or a bound of
    it) once for each key; total, where the caller knows it, is the sum of these numbers.

    A key with at least a 10,000th of all rows is frequent. Its rows are dealt out over as many parts as it has 10,000ths, and its rows
    of other are repeated for each part, at most 20,000 repetitions for all keys together when other has a row for each key. What is
    broadcast to tell frequent keys are at most 10,000 rows of a hash and a number, 16 bytes each, however long the keys are. rows is
    read once.
    """
    if total is None:
        total = counts.agg(F.coalesce(F.sum(name), F.lit(0))).first()[0]
    least = max(2.0, total * FREQUENT_SHARE)
    parts = F.ceil(F.col(name) / F.lit(least)).cast("int")
    hot = F.broadcast(counts.where(F.col(name) >= least).groupBy(F.xxhash64(key).alias("__hot")).agg(F.max(parts).alias("__parts")))
    told = [f.name for f in rows.schema if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    part = F.pmod(F.xxhash64(F.lit(7), *(F.col(f"`{c}`") for c in told)), F.coalesce("__parts", F.lit(1))).cast("int")
    dealt = rows.join(hot, F.xxhash64(key) == F.col("__hot"), "left").withColumn("__part", part).drop("__hot", "__parts")
    copied = other.join(hot, F.xxhash64(key) == F.col("__hot"), "left")
    copied = copied.withColumn("__part", F.explode(F.sequence(F.lit(0), F.coalesce("__parts", F.lit(1)) - 1))).drop("__hot", "__parts")
    return dealt.join(copied, [key, "__part"]).drop("__part")


def _two_hashes(key: str) -> list[Column]:
    """128 bits that stand for a key of any length."""
    return [F.xxhash64(key).alias("__h1"), F.xxhash64(F.lit(7), F.col(f"`{key}`")).alias("__h2")]


def join_frequencies(rows: DataFrame, freq: DataFrame, key: str, name: str = "df") -> DataFrame:
    """rows with the one row of freq that has their key (inner join), for a freq that is a written table and holds the key's number
    of rows as name.

    Where freq holds numbers only beside the key, rows of frequent keys are looked up in a broadcast table - at most 10,000 rows of two hashes
    in place of the key and these numbers - and aren't shuffled; any other key has less than a 10,000th of the rows. Where it holds values of
    any size, rows of frequent keys are dealt out as join_salted does.
    """
    others = [f for f in freq.schema if f.name != key]
    if not all(isinstance(f.dataType, (T.NumericType, T.BooleanType, T.DateType, T.TimestampType)) for f in others):
        return join_salted(rows, freq, key, freq, name)
    least = max(2.0, (freq.agg(F.coalesce(F.sum(name), F.lit(0))).first()[0]) * FREQUENT_SHARE)
    names = [f.name for f in others]
    hot = F.broadcast(freq.where(F.col(name) >= least).select(*_two_hashes(key), *names))
    cold = freq.where(F.col(name) < least)
    hashed = rows.where(F.col(f"`{key}`").isNotNull()).select("*", *_two_hashes(key))
    columns = [F.col(f"`{c}`") for c in (key, *(c for c in rows.columns if c != key), *names)]
    told = hashed.join(hot, ["__h1", "__h2"]).select(*columns)
    rest = hashed.join(hot.select("__h1", "__h2"), ["__h1", "__h2"], "left_anti").drop("__h1", "__h2")
    return told.unionByName(rest.join(cold, key).select(*columns))
