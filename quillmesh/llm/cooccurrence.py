"""Items that appear together: an incremental table of pair counts and their association.

The table keeps the last form of each basket. A batch brings baskets; those that differ from what is kept emit a signed delta for each
pair and each item of their old and their new form. Deltas are summed on the map side, merged into persistent counts that lie in hash
buckets - only touched buckets are written again - and the association is computed again for the pairs that the batch affects: pairs
whose own count has changed and pairs of an item whose count has changed.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmesh.operators.frequency import frequencies, join_salted

#: Buckets are doubled when those of a kind hold more bytes than this on average.
BYTES_PER_BUCKET = 128 << 20
#: The first items of baskets with more items than this are dealt out over tasks before their pairs are formed.
LARGE_BASKET = 1_000


def tag_item(tag: Column) -> Column:
    """`tag:` and the tag in lower case without leading #, spaces and underscores as single blanks; null for a blank tag."""
    t = F.trim(F.regexp_replace(F.regexp_replace(F.lower(tag), r"^[\s_]*#+", ""), r"[\s_\u00a0]+", " "))
    return F.when(t != "", F.concat(F.lit("tag:"), t))


def type_item(entry_type: Column) -> Column:
    """`type:` and the last path segment that isn't empty, in lower case; null for a blank type."""
    segments = F.filter(F.transform(F.split(F.lower(entry_type), "/"), lambda x: F.trim(x)), lambda s: s != "")
    last = F.element_at(segments, -1)
    return F.when(F.size(segments) > 0, F.concat(F.lit("type:"), last))


def items_of(tags: Column, entry_types: Column) -> Column:
    """The sorted distinct items of one basket; an empty array where there are none."""
    none = F.array().cast("array<string>")
    both = F.concat(F.coalesce(F.transform(tags, tag_item), none), F.coalesce(F.transform(entry_types, type_item), none))
    return F.array_sort(F.array_distinct(F.array_compact(both)))


#: What orders the forms of a basket: the time it was parsed, then the entry's id.
AT = "struct<parsed_at:timestamp,entry_id:bigint>"


def current_baskets(entries: DataFrame) -> DataFrame:
    """basket, items, at: of each url the row with the latest parsed_at (ties: greatest entry_id). Rows without a url are left out; a
    row without a time counts as older than all others."""
    first = F.coalesce("parsed_at", F.lit("0001-01-01 00:00:00").cast("timestamp")), F.coalesce("entry_id", F.lit(-(2**63)).cast("bigint"))
    rows = entries.where("url is not null").select(F.col("url").alias("basket"), items_of(F.col("tags"), F.col("entry_type")).alias("items"), F.struct(first[0].alias("parsed_at"), first[1].alias("entry_id")).alias("at"))
    return rows.groupBy("basket").agg(F.max_by("items", "at").alias("items"), F.max("at").alias("at"))


def _signed(changed: DataFrame) -> DataFrame:
    sides = F.array(F.struct(F.col("old_items").alias("items"), F.lit(-1).alias("sign")), F.struct(F.col("new_items").alias("items"), F.lit(1).alias("sign")))
    return changed.select(F.explode(sides).alias("s")).select("s.items", "s.sign").where("items is not null")


def item_deltas(changed: DataFrame) -> DataFrame:
    """item, n: signed changes of the item counts, and of the number of baskets under the item null. changed: basket, old_items,
    new_items; null where a basket wasn't or isn't there."""
    side = _signed(changed)
    items = side.select(F.explode("items").alias("item"), "sign").unionByName(side.select(F.lit(None).cast("string").alias("item"), "sign"))
    return items.groupBy("item").agg(F.sum("sign").alias("n")).where("n <> 0")


def pair_deltas(changed: DataFrame) -> DataFrame:
    """item_a < item_b, n: signed changes of the pair counts. A basket's pairs are generated item by item, never held together; those of a
    large basket in many tasks."""
    side = _signed(changed)
    large = F.size("items") > LARGE_BASKET
    firsts = lambda df: df.select("items", "sign", F.posexplode("items").alias("at", "item_a"))
    both = firsts(side.where(~large)).unionByName(firsts(side.where(large)).repartition("item_a"))
    pairs = both.select("item_a", F.explode(F.expr("slice(items, at + 2, size(items))")).alias("item_b"), "sign")
    return pairs.groupBy("item_a", "item_b").agg(F.sum("sign").alias("n")).where("n <> 0")


class PairTable:
    """Persistent baskets, counts and scores in a folder that all executors share.

    <kind>/v=<version>/bucket=<b> hold the rows of a kind; manifest/<version> names the version that holds each bucket. A batch writes the
    buckets it touches under a new version and then the manifest: a batch that fails changes nothing, a batch that is repeated
    under its id is applied once. The number of buckets follows the number of rows.
    """

    KEYS = {"baskets": ("basket",), "pairs": ("item_a", "item_b"), "items": ("item",), "scores": ("item_a", "item_b")}

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64, at: str = AT):
        self.spark, self.path, self.buckets = spark, path, buckets
        counted = "n bigint, version int"
        self.schemas = {"baskets": f"basket string, items array<string>, at {at}", "pairs": f"item_a string, item_b string, {counted}", "items": f"item string, {counted}", "scores": "item_a string, item_b string, n_ab bigint, n_a bigint, n_b bigint"}

    def _path(self, *names: str):
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path("/".join((self.path, *names)))
        return path, path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _manifest(self) -> dict:
        folder, fs = self._path("manifest")
        found = [x.getPath().getName() for x in fs.listStatus(folder)] if fs.exists(folder) else []
        done = [n for n in found if n.isdigit() and fs.exists(self._path("manifest", n, "_SUCCESS")[0])]
        if not done:
            return {"version": 0, "batches": [], "buckets": self.buckets} | {k: {} for k in self.KEYS}
        return json.loads(self.spark.read.text(f"{self.path}/manifest/{max(done, key=int)}").first()[0])

    def _read(self, kind: str, held: dict) -> DataFrame:
        paths = [f"{self.path}/{kind}/v={v}/bucket={b}" for b, v in held.items()]
        return self.spark.read.schema(self.schemas[kind]).parquet(*paths) if paths else self.spark.createDataFrame([], self.schemas[kind])

    def _stage(self, df: DataFrame, version: int, name: str) -> DataFrame:
        """df written once, for the steps of a batch that read it."""
        df.write.mode("overwrite").parquet(f"{self.path}/stage/v={version}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.path}/stage/v={version}/{name}")

    @staticmethod
    def _bucket(keys: tuple[str, ...], buckets: int) -> Column:
        return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")

    def _touched(self, df: DataFrame, kind: str, old: dict) -> tuple[list[str], DataFrame]:
        """The buckets that rows of df fall into - at most all, so the list is bounded - and what these hold."""
        touched = [str(r[0]) for r in df.select(self._bucket(self.KEYS[kind], old["buckets"]).alias("b")).distinct().collect()]
        return touched, self._read(kind, {b: old[kind][b] for b in touched if b in old[kind]})

    def _replace(self, kind: str, rows: DataFrame, touched: list[str], new: dict) -> None:
        """Writes the rows of the touched buckets under the new version; a bucket without rows is gone."""
        keys, folder = self.KEYS[kind], f"{self.path}/{kind}/v={new['version']}"
        placed = rows.withColumn("bucket", self._bucket(keys, new["buckets"]))
        placed.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(folder)
        root, fs = self._path(kind, f"v={new['version']}")
        for b in touched:
            new[kind].pop(b, None)
        new[kind] |= {n.split("=")[1]: new["version"] for n in (x.getPath().getName() for x in fs.listStatus(root)) if n.startswith("bucket=")}

    def counts(self, kind: str) -> DataFrame:
        return self._read(kind, self._manifest()[kind]).drop("version")

    def update(self, batch: str, baskets: DataFrame) -> None:
        """Takes in one batch: baskets has basket (one row each), items (null if the basket is gone) and at. A form that isn't later than the
        kept one is late and changes nothing."""
        old = self._manifest()
        if batch in old["batches"]:
            return
        if self._largest(old) > BYTES_PER_BUCKET * old["buckets"]:
            old = self._grown(old)
        new = {"version": old["version"] + 1, "batches": [*old["batches"], batch], "buckets": old["buckets"]} | {k: dict(old[k]) for k in self.KEYS}
        version = new["version"]
        incoming = self._stage(baskets.select("basket", "items", "at"), version, "incoming")
        touched, kept = self._touched(incoming, "baskets", old)
        sides = kept.withColumn("new", F.lit(False)).unionByName(incoming.withColumn("new", F.lit(True)))
        last = F.max_by(F.struct("items", "at"), F.struct("at", "new")).alias("last")
        merged = sides.groupBy("basket").agg(last, F.max(F.when(~F.col("new"), F.struct("items"))).alias("before"))
        merged = self._stage(merged.select("basket", F.col("before.items").alias("old_items"), F.col("last.items").alias("new_items"), "last.at"), version, "merged")
        # A basket that is gone keeps its row, without items, so that a late form of it stays out.
        self._replace("baskets", merged.select("basket", F.col("new_items").alias("items"), "at"), touched, new)
        changed = merged.where(~F.col("old_items").eqNullSafe(F.col("new_items")))
        deltas = {}
        for kind, found in (("pairs", pair_deltas(changed)), ("items", item_deltas(changed))):
            delta = deltas[kind] = self._stage(found, version, kind)
            touched, before = self._touched(delta, kind, old)
            both = before.unionByName(delta.withColumn("version", F.lit(version)))
            self._replace(kind, both.groupBy(*self.KEYS[kind]).agg(F.sum("n").alias("n"), F.max("version").alias("version")).where("n <> 0"), touched, new)
        self._rescore(deltas["pairs"], old, new)
        self.spark.createDataFrame([(json.dumps(new),)], "value string").coalesce(1).write.mode("overwrite").text(f"{self.path}/manifest/{version}")
        self._path("stage", f"v={version}")[1].delete(self._path("stage", f"v={version}")[0], True)

    def _largest(self, held: dict) -> int:
        """Bytes of the largest kind."""
        size = lambda kind, v, b: (lambda path, fs: fs.getContentSummary(path).getLength())(*self._path(kind, f"v={v}", f"bucket={b}"))
        return max(sum(size(kind, v, b) for b, v in held[kind].items()) for kind in self.KEYS)

    def _grown(self, old: dict) -> dict:
        """The same rows in twice as many buckets, until they are few enough; under a version of its own."""
        new = dict(old) | {"version": old["version"] + 1, "buckets": old["buckets"] * 2} | {k: {} for k in self.KEYS}
        while self._largest(old) > BYTES_PER_BUCKET * new["buckets"]:
            new["buckets"] *= 2
        for kind in self.KEYS:
            self._replace(kind, self._read(kind, old[kind]), [], new)
        self.spark.createDataFrame([(json.dumps(new),)], "value string").coalesce(1).write.mode("overwrite").text(f"{self.path}/manifest/{new['version']}")
        return new

    def _rescore(self, pair_delta: DataFrame, old: dict, new: dict) -> None:
        """Scores of the affected pairs, in place of what was there; items in very many pairs are dealt out over parts."""
        version, pairs, items = new["version"], self._read("pairs", new["pairs"]), self._read("items", new["items"]).where("item is not null")
        total = pairs.count()
        per = {c: self._stage(frequencies(pairs, c, "pairs"), version, f"per-{c}") for c in ("item_a", "item_b")}

        def with_item(rows: DataFrame, column: str, table: DataFrame) -> DataFrame:
            return join_salted(rows, table.withColumnRenamed("item", column), column, per[column], "pairs", total)

        moved = items.where(F.col("version") == version).select("item")
        columns = ("item_a", "item_b", "n")
        affected = pairs.where(F.col("version") == version).select(*columns)
        for c in ("item_a", "item_b"):
            affected = affected.unionByName(with_item(pairs.where(F.col("version") < version).select(*columns), c, moved).select(*columns))
        affected = self._stage(affected.distinct(), version, "affected")
        scored = affected.withColumnRenamed("n", "n_ab")
        for c, n in (("item_a", "n_a"), ("item_b", "n_b")):
            scored = with_item(scored, c, items.select("item", F.col("n").alias(n)))
        scored = scored.select("item_a", "item_b", "n_ab", "n_a", "n_b")
        keys = affected.select("item_a", "item_b").unionByName(pair_delta.select("item_a", "item_b"))
        touched, before = self._touched(keys, "scores", old)
        none = [F.lit(None).cast("bigint").alias(c) for c in ("n_ab", "n_a", "n_b")]
        # A pair whose count has fallen to zero has a delta but no new score.
        layers = before.withColumn("layer", F.lit(0)).unionByName(pair_delta.select("item_a", "item_b", *none, F.lit(1).alias("layer"))).unionByName(scored.withColumn("layer", F.lit(2)))
        best = layers.groupBy("item_a", "item_b").agg(F.max_by(F.struct("n_ab", "n_a", "n_b"), "layer").alias("s")).select("item_a", "item_b", "s.n_ab", "s.n_a", "s.n_b")
        self._replace("scores", best.where("n_ab is not null"), touched, new)

    def association(self, least_count: int = 1) -> DataFrame:
        """item_a, item_b, n_ab, n_a, n_b, n, lift and pmi of the pairs with at least least_count baskets. The counts are kept; the number of
        baskets, which is in every score, comes in here."""
        held = self._manifest()
        total = self._read("items", held["items"]).where("item is null").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        lift = F.col("n_ab") * F.lit(float(total)) / (F.col("n_a") * F.col("n_b"))
        return self._read("scores", held["scores"]).where(F.col("n_ab") >= least_count).select("item_a", "item_b", "n_ab", "n_a", "n_b", F.lit(total).cast("bigint").alias("n"), lift.alias("lift"), F.log2(lift).alias("pmi"))
