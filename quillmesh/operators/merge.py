"""Keyed merges of new observations into a table: one rule for each column, one row for each key.

Plain Parquet tables have no MERGE; a merge is a full outer join on the key with a rule for each column, and the buckets it touches are
written as a new version of the table beside the old one (VersionedTable). Batches are reduced to one row for each key before the join, with
aggregates that combine on the map side, so a key that holds a large part of a batch costs no hot task.
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from quillmesh.operators.frequency import join_frequencies
from quillmesh.session import Workspace

Rule = Callable[[Column, Column, Column], Column]
"""(old value, new value, whether the key is in the new batch) -> merged value."""


def newest(old: Column, new: Column, present: Column) -> Column:
    """The new value, null included, where the key is in the batch."""
    return F.when(present, new).otherwise(old)


def new_if_given(old: Column, new: Column, present: Column) -> Column:
    """The new value unless it is null."""
    return F.coalesce(new, old)


def keep_old(old: Column, new: Column, present: Column) -> Column:
    """The old value once there is one: insert-only columns and columns another writer owns."""
    return F.coalesce(old, new)


def either(old: Column, new: Column, present: Column) -> Column:
    """True once either is true: flags that never go back."""
    return F.coalesce(old, F.lit(False)) | F.coalesce(new, F.lit(False))


def added(old: Column, new: Column, present: Column) -> Column:
    """The sum; a missing side counts 0."""
    return F.coalesce(old, F.lit(0)) + F.coalesce(new, F.lit(0))


def latest_of(old: Column, new: Column, present: Column) -> Column:
    return F.greatest(old, new)


def last_in_batch(batch: DataFrame, key: str, order: list[str]) -> DataFrame:
    """One row for each key: the greatest by order (a batch is a sequence, its last record holds). Rows with a null key are left out."""
    rest = [c for c in batch.columns if c != key]
    best = F.max_by(F.struct(*(F.col(f"`{c}`") for c in rest)), F.struct(*(F.col(f"`{c}`") for c in order)))
    return batch.where(F.col(f"`{key}`").isNotNull()).groupBy(key).agg(best.alias("__v")).select(key, *(F.col(f"__v.`{c}`").alias(c) for c in rest))


def keyed_merge(old: DataFrame, new: DataFrame, key: str, rules: dict[str, Rule], insert: bool = True) -> DataFrame:
    """old merged with new (one row for each key in either), with the columns of old in their order, and `__outcome`: added, updated or
    kept.

    A column without a rule takes the new value where the key is in the batch and the batch has the column. Columns of the batch that
    old lacks are added after them. insert: keys that only new has become rows; without it they are dropped (update-only).
    """
    columns = [*old.columns, *(c for c in new.columns if c not in old.columns)]
    o = old.select(F.col(f"`{key}`").alias("__ok"), F.struct(*(F.col(f"`{c}`") for c in old.columns)).alias("__o"))
    n = new.where(F.col(f"`{key}`").isNotNull()).select(F.col(f"`{key}`").alias("__nk"), F.struct(*(F.col(f"`{c}`") for c in new.columns)).alias("__n"))
    both = o.join(n, F.col("__ok") == F.col("__nk"), "full" if insert else "left")
    present = F.col("__nk").isNotNull()

    def value(c: str) -> Column:
        if c == key:
            return F.coalesce("__ok", "__nk").alias(c)
        was = F.col(f"__o.`{c}`") if c in old.columns else F.lit(None)
        if c not in new.columns:
            return was.alias(c) if c not in rules else rules[c](was, F.lit(None).cast(old.schema[c].dataType), present).alias(c)
        return rules.get(c, newest)(was, F.col(f"__n.`{c}`"), present).alias(c)

    outcome = F.when(~present, "kept").when(F.col("__ok").isNull(), "added").otherwise("updated")
    return both.select(*(value(c) for c in columns), outcome.alias("__outcome"))


DISCOVERY_RULES: dict[str, Rule] = {"confirmed": either, "last_scraped": keep_old, "page_template_type": keep_old, "namespace": new_if_given, "lastmod": new_if_given}


def merge_discovery(known: DataFrame, batch: DataFrame, order: list[str], key: str = "url") -> DataFrame:
    """Discovery records into the known ones: of a key's records in the batch the last holds; values win over nulls, a confirmed key stays
    confirmed, what other stages wrote stays, and a key that isn't confirmed has no lastmod."""
    merged = keyed_merge(known, last_in_batch(batch, key, order).select(*(c for c in batch.columns if c in known.columns)), key, DISCOVERY_RULES)
    return merged.withColumn("lastmod", F.when(F.col("confirmed"), F.col("lastmod")))


def fold_fetches(log: DataFrame, stored: DataFrame, key: str = "url") -> DataFrame:
    """The fetch outcomes of each key, in the order of seq, folded onto its stored state.

    log: key, seq, ok, html (or any payload column `payload`), error, error_kind, attempts_used, at. stored: key, scrape_status, payload,
    attempts, first_at. A good outcome sets the payload and clears the errors, a failed one leaves a good page as it is and counts as
    kept_ok; an ok without payload is a failure. The state after a sequence needs only three facts - the last good outcome, the last
    outcome and the sums - so it is an aggregate, not a walk through a collected list.
    """
    good = F.col("ok") & F.col("payload").isNotNull() & (F.col("payload") != "")
    at = F.struct("seq", "at")
    facts = log.where(f"`{key}` is not null").groupBy(key).agg(
        F.max(F.when(good, at)).alias("good_at"), F.max_by(F.when(good, F.col("payload")), F.when(good, at)).alias("new_payload"), F.max(at).alias("last_at"), F.max_by(F.when(good, F.lit(None)).otherwise(F.struct("error", "error_kind")), at).alias("last_error"),
        F.sum("attempts_used").alias("used"), F.min(F.when(good, F.col("at"))).alias("first_good"), F.count_if(good).alias("n_ok"), F.count_if(~good).alias("n_bad"), F.min(F.when(good, at)).alias("first_good_at"), F.count(F.lit(1)).alias("n"),
    )
    s = stored.select(F.col(key).alias("__k"), *(F.col(c).alias(f"__{c}") for c in ("scrape_status", "payload", "attempts", "first_at")))
    j = facts.join(s, F.col(key) == F.col("__k"), "left")
    had = F.coalesce((F.col("__scrape_status") == "ok") & F.col("__payload").isNotNull(), F.lit(False))
    is_ok = F.col("good_at").isNotNull() | had
    return j.select(
        key, F.when(is_ok, "ok").otherwise("failed").alias("scrape_status"), F.coalesce("new_payload", "__payload").alias("payload"), (F.coalesce("__attempts", F.lit(0)) + F.col("used")).alias("attempts"), F.coalesce("__first_at", "first_good").alias("first_at"),
        F.col("last_error.error").alias("last_error"), F.col("last_error.error_kind").alias("last_error_kind"), F.col("n_ok").alias("ok"), F.col("n_bad").alias("bad"), had.alias("was_ok"),
    )


def fetch_tallies(log: DataFrame, stored: DataFrame, key: str = "url") -> DataFrame:
    """outcome, n: how many outcomes were ok, failed, or kept_ok - a failure after a page was already held, by an earlier outcome or before. A
    key with a large part of the log is dealt out over parts."""
    rows = log.where(f"`{key}` is not null")
    good = F.col("ok") & F.col("payload").isNotNull() & (F.col("payload") != "")
    work = Workspace(log.sparkSession, "tallies")
    per = rows.groupBy(key).agg(F.min(F.when(good, F.col("seq"))).alias("__first"), F.count_if(good).alias("__ok"), F.count(F.lit(1)).alias("__n"))
    held = stored.where("scrape_status = 'ok' and payload is not null").select(key, F.lit(True).alias("__held")).distinct()
    per = work.write(per.join(held, key, "left"), "per")
    failed = rows.where(~F.coalesce(good, F.lit(False))).select(key, "seq")
    later = join_frequencies(failed, per.where("__held or __first is not null"), key, "__n").where("__held or __first < seq")
    totals = per.agg(F.coalesce(F.sum("__ok"), F.lit(0)).alias("ok"), F.coalesce(F.sum(F.col("__n") - F.col("__ok")), F.lit(0)).alias("bad")).crossJoin(later.agg(F.count(F.lit(1)).alias("kept_ok")))
    told = F.array(*(F.struct(F.lit(name).alias("outcome"), n.alias("n")) for name, n in (("ok", F.col("ok")), ("kept_ok", F.col("kept_ok")), ("failed", F.col("bad") - F.col("kept_ok")))))
    return totals.select(F.explode(told).alias("t")).select("t.outcome", "t.n").where("n > 0")


def dead_letters(failures: DataFrame, batch: DataFrame, resolved: DataFrame, at: Column, most_error: int = 2000, key: str = "url") -> DataFrame:
    """Failure rows after a batch: new failures are merged in (attempts + 1, the error cut), keys that parsed are removed."""
    new = batch.select(key, F.left(F.col("error"), F.lit(most_error)).alias("error"), "error_type", "content_sha256", at.alias("failed_at"), F.lit(1).alias("attempts"))
    merged = keyed_merge(failures, last_in_batch(new, key, ["failed_at", "error"]), key, {"attempts": added}).drop("__outcome")
    return merged.join(resolved.select(key).distinct(), key, "left_anti")


class VersionedTable:
    """A table kept as versions in one folder that all executors share.

    data/<id>/bucket=<b> hold rows; versions/<n>.json names the data that each bucket of version n has, the schema, the key that buckets
    are made by, and the last batch of each stream that was merged. A version counts once its file is there, and the file is created
    only if it isn't there: a merge that fails leaves the table as it was, readers of an older version aren't disturbed, and of two
    writers one gets an error. A merge rewrites only the buckets that its batch touches. A bucket holds about BYTES of data at most:
    the number of buckets doubles with the table.
    """

    BYTES = 128 << 20

    def __init__(self, spark: SparkSession, path: str, buckets: int = 4):
        self.spark, self.path, self.least_buckets = spark, path, buckets

    def _at(self, *names: str):
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path("/".join((self.path, *names)))
        return path, path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def version(self) -> int:
        folder, fs = self._at("versions")
        names = [x.getPath().getName() for x in fs.listStatus(folder)] if fs.exists(folder) else []
        return max((int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit()), default=0)

    def _manifest(self, version: int) -> dict:
        path, fs = self._at("versions", f"{version}.json")
        stream = fs.open(path)
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def _commit(self, version: int, manifest: dict) -> int:
        """The file is written under a name of its own and renamed, which fails where another writer was first."""
        own, fs = self._at("versions", f"_{uuid.uuid4().hex}")
        stream = fs.create(own, False)
        stream.write(bytearray(json.dumps(manifest).encode()))
        stream.close()
        target, _ = self._at("versions", f"{version}.json")
        if fs.exists(target) or not fs.rename(own, target):
            fs.delete(own, False)
            raise RuntimeError(f"{self.path}: another writer has made version {version}")
        return version

    def _rows(self, manifest: dict, buckets: list[str] | None = None, outcome: bool = False) -> DataFrame:
        held = {b: d for b, d in manifest["data"].items() if buckets is None or b in buckets}
        schema = StructType.fromJson(manifest["schema"])
        if outcome:
            schema = StructType([*schema.fields, StructField("__outcome", StringType())])
        if not held:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*(f"{self.path}/data/{d}/bucket={b}" for b, d in held.items()))

    def read(self) -> DataFrame:
        v = self.version()
        if not v:
            raise FileNotFoundError(f"{self.path} has no version yet")
        return self._rows(self._manifest(v))

    def _store(self, rows: DataFrame, key: str | None, buckets: int) -> dict[str, str]:
        """Writes rows once, by bucket; the new data of each bucket that has rows."""
        name = uuid.uuid4().hex[:12]
        bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int") if key else F.lit(0)
        placed = rows.withColumn("bucket", bucket)
        (placed.repartition("bucket") if key else placed).write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/data/{name}")
        root, fs = self._at("data", name)
        return {n.split("=")[1]: name for n in (x.getPath().getName() for x in fs.listStatus(root)) if n.startswith("bucket=")}

    def write(self, df: DataFrame) -> int:
        """The whole table anew."""
        v = self.version()
        applied = self._manifest(v)["applied"] if v else {}
        return self._commit(v + 1, {"key": None, "buckets": 1, "schema": df.schema.jsonValue(), "data": self._store(df, None, 1), "applied": applied})

    def write_empty_if_new(self, like: DataFrame) -> None:
        if not self.version():
            self._commit(1, {"key": None, "buckets": 1, "schema": like.schema.jsonValue(), "data": {}, "applied": {}})

    def applied(self, source: str) -> int:
        """The last batch of a stream that the table has, -1 for none."""
        v = self.version()
        return self._manifest(v)["applied"].get(source, -1) if v else -1

    def merge(self, batch: DataFrame, key: str, rules: dict[str, Rule], insert: bool = True, source: tuple[str, int] | None = None) -> dict[str, int]:
        """Writes the touched buckets of the merged table and returns how many keys were added and updated. source: (stream, batch); a
        batch of a stream that isn't later than the last one merged changes nothing."""
        self.write_empty_if_new(batch)
        v = self.version()
        old = self._manifest(v)
        if source and old["applied"].get(source[0], -1) >= source[1]:
            return {"added": 0, "updated": 0}
        size = sum((lambda path, fs: fs.getContentSummary(path).getLength())(*self._at("data", d, f"bucket={b}")) for b, d in old["data"].items())
        buckets = max(self.least_buckets, 1 << max(0, math.ceil(size / self.BYTES) - 1).bit_length())
        new = batch.where(F.col(f"`{key}`").isNotNull())
        if old["key"] == key and old["buckets"] >= buckets:
            buckets = old["buckets"]
            # a number for each bucket at most
            touched = [str(r[0]) for r in new.select(F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").alias("b")).distinct().collect()]
        else:
            touched = None
        merged = keyed_merge(self._rows(old, touched), new, key, rules, insert)
        stored = self._store(merged, key, buckets)
        data = stored if touched is None else {b: d for b, d in old["data"].items() if b not in touched} | stored
        schema = merged.drop("__outcome").schema.jsonValue()
        manifest = {"key": key, "buckets": buckets, "schema": schema, "data": data, "applied": old["applied"] | ({source[0]: source[1]} if source else {})}
        counts = {r[0]: r[1] for r in self._rows(manifest | {"data": stored}, outcome=True).groupBy("__outcome").count().collect()}  # three rows
        self._commit(v + 1, manifest)
        return {"added": counts.get("added", 0), "updated": counts.get("updated", 0)}
