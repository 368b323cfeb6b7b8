"""Only new or changed records, run after run, without skipping or repeating any.

A run rereads from the oldest transaction that was open when the last run committed - rows of that transaction may have become
visible since - and removes the overlap by an anti-join of (key, version) pairs against the ledger of what has been processed.
A run's pairs are appended to the ledger under its run id after its results are written, and count only once its commit marker
is there. A run that fails therefore leaves nothing behind that counts, and the next one takes up the same records.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def reread_from(changes: DataFrame, visible_at: Column, horizon: datetime | None) -> DataFrame:
    """Rows that became visible at or after the horizon; all rows where there is none. Rows without a time are always reread."""
    return changes if horizon is None else changes.where(visible_at.isNull() | (visible_at >= F.lit(horizon)))


def unprocessed(changes: DataFrame, ledger: DataFrame, keys: list[str], version: str) -> DataFrame:
    """Rows of changes whose key and version aren't in the ledger. Null keys and versions are values like any other."""
    a, b = changes.alias("a"), ledger.select(*keys, version).distinct().alias("b")
    on = [F.col(f"a.`{c}`").eqNullSafe(F.col(f"b.`{c}`")) for c in (*keys, version)]
    return a.join(b, on, "left_anti").select("a.*")


def latest(df: DataFrame, keys: list[str], order: list[Column], values: list[str]) -> DataFrame:
    """One row for each key: the values of the row that is greatest by order. An aggregate with a partial step on the map side, so
    a key that holds a third of all rows doesn't end in one task; rows whose first order value is null are left out."""
    best = F.max_by(F.struct(*(F.col(f"`{c}`") for c in values)), F.struct(*order)).alias("__v")
    return df.where(order[0].isNotNull()).groupBy(*keys).agg(best).select(*keys, *(F.col(f"__v.`{c}`").alias(c) for c in values))


@dataclass
class Ledger:
    """The processed pairs and the commits of one consumer, in a folder that all executors share.

    pairs/run=<id> holds the pairs of a run; commits/<id> its marker, with the horizon of the next run. A run is written under its
    own id with overwrite, so a run that is repeated after a failure replaces its own unfinished part.
    """

    spark: SparkSession
    path: str
    schema: str

    def _commits(self) -> list[dict]:
        folder = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/commits")
        fs = folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(folder):
            return []
        rows = self.spark.read.option("recursiveFileLookup", "true").text(f"{self.path}/commits").collect()  # one row for each run
        return sorted((json.loads(r[0]) for r in rows), key=lambda c: c["at"])

    def horizon(self) -> datetime | None:
        """Where the next run starts to read: the oldest transaction open at the last commit; None before the first."""
        commits = self._commits()
        return datetime.fromisoformat(commits[-1]["oldest_open"]) if commits and commits[-1]["oldest_open"] else None

    def processed(self) -> DataFrame:
        """The pairs of all committed runs."""
        paths = [f"{self.path}/pairs/run={c['run']}" for c in self._commits()]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def last(self, key: str) -> DataFrame:
        """Of each key the pair of the last committed run that has one: where a key's later state replaces its earlier ones."""
        runs = self._commits()
        if not runs:
            return self.spark.createDataFrame([], self.schema)
        parts = [self.spark.read.schema(self.schema).parquet(f"{self.path}/pairs/run={c['run']}").withColumn("__run", F.lit(n)) for n, c in enumerate(runs)]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        names = [c for c in out.columns if c != "__run"]
        return out.groupBy(F.col(key).alias("__k")).agg(F.max_by(F.struct(*names), "__run").alias("v")).select(*(F.col(f"v.{c}") for c in names))

    def commit(self, run: str, pairs: DataFrame, at: datetime, oldest_open: datetime | None) -> None:
        """Ends a run: pairs are what it has processed, oldest_open the start of the oldest transaction still open at that time."""
        if any(c["run"] == run for c in self._commits()):
            return
        pairs.write.mode("overwrite").parquet(f"{self.path}/pairs/run={run}")
        marker = json.dumps({"run": run, "at": at.isoformat(), "oldest_open": oldest_open.isoformat() if oldest_open else None})
        self.spark.createDataFrame([(marker,)], "value string").coalesce(1).write.mode("overwrite").text(f"{self.path}/commits/{run}")

    def pending(self, changes: DataFrame, visible_at: Column, keys: list[str], version: str) -> DataFrame:
        """What the next run has to process."""
        return unprocessed(reread_from(changes, visible_at, self.horizon()), self.processed(), keys, version)


def succeeded_runs(runs: DataFrame) -> DataFrame:
    """run_id of the runs whose row with the latest created_at says success. Of rows at one time the greatest state by name counts,
    and success is the greatest of the known ones; runs without an id or a time are left out."""
    last = latest(runs.where("run_id is not null"), ["run_id"], [F.col("created_at"), F.col("state")], ["state"])
    return last.where("state = 'success'").select("run_id")


def good_fetches(doms: DataFrame) -> DataFrame:
    """dom_id, url, version, fetched_at, worker_id, received_at of the fetches that hold a page; the version is the stored hash in
    lower case, or that of the html where none is stored. The html itself goes no further."""
    held = doms.where("scrape_status = 'ok' and html is not null and url is not null")
    return held.select("dom_id", "url", F.lower(F.coalesce("content_sha256", F.sha2("html", 256))).alias("version"), "fetched_at", "worker_id", "received_at")


STATE = "url string, confirmed boolean, lastmod_us bigint, fetched_us bigint, current string, parsed boolean, done string"


def url_states(urls: DataFrame, fetches: DataFrame, entries: DataFrame, runs: DataFrame) -> DataFrame:
    """What decides on a url, one row each, and its version: whether it is confirmed, its latest lastmod, the instant and hash of its current
    fetch, whether an entry of a succeeded run answers it and that entry's hash; the version is a hash of all that.

    urls: url, confirmed, lastmod_us (microseconds, or null). fetches: good_fetches with fetched_us. entries: url, dom_content_sha256,
    run_id, parsed_at, entry_id. runs: run_id, state, created_at. Rows with a null url and fetches without an instant are left out; of
    fetches at one instant the greatest dom_id counts.
    """
    newest = latest(fetches.where("url is not null"), ["url"], [F.col("fetched_us"), F.col("dom_id")], ["version", "fetched_us"])
    committed = entries.join(succeeded_runs(runs), "run_id", "left_semi").where("url is not null")
    committed = committed.select("url", "parsed_at", "entry_id", F.lower("dom_content_sha256").alias("version"))
    done = latest(committed, ["url"], [F.col("parsed_at"), F.col("entry_id")], ["version"])
    known = urls.where("url is not null").groupBy("url").agg(F.max("confirmed").alias("confirmed"), F.max("lastmod_us").alias("lastmod_us"))
    parts = known.unionByName(newest.select("url", "fetched_us", F.col("version").alias("current")), allowMissingColumns=True)
    parts = parts.unionByName(done.select("url", F.lit(True).alias("parsed"), F.col("version").alias("done")), allowMissingColumns=True)
    names = [f.split()[0] for f in STATE.split(", ")][1:]
    states = parts.groupBy("url").agg(*(F.max(c).alias(c) for c in names))
    return states.withColumn("version", F.md5(F.to_json(F.struct(*names))))


def stages_of(states: DataFrame) -> DataFrame:
    """(url, stage): parse where the current fetch has another hash than the entry that answers the url or none does; fetch where a confirmed
    url has no good fetch or one from before its lastmod."""
    parse = F.col("fetched_us").isNotNull() & ~(F.coalesce("parsed", F.lit(False)) & F.col("done").eqNullSafe(F.col("current")))
    fetch = F.col("confirmed") & (F.col("fetched_us").isNull() | (F.col("lastmod_us") > F.col("fetched_us")))
    named = F.array_compact(F.array(F.when(parse, F.lit("parse")), F.when(fetch, F.lit("fetch"))))
    return states.select("url", F.explode(named).alias("stage"))


def touched_urls(urls: DataFrame, fetches: DataFrame, entries: DataFrame, runs: DataFrame, horizon: datetime) -> DataFrame:
    """The urls with a row that became visible at or after the horizon: discovered, received or parsed since, or of a run whose state was
    reported since. Rows without a time count as new."""
    told = [(urls, "discovered_at"), (fetches, "received_at"), (entries, "parsed_at")]
    parts = [reread_from(df, F.col(at), horizon).select("url") for df, at in told]
    parts.append(entries.join(reread_from(runs, F.col("created_at"), horizon).select("run_id").distinct(), "run_id", "left_semi").select("url"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.where("url is not null").distinct()


def changed_states(ledger: Ledger, urls: DataFrame, fetches: DataFrame, entries: DataFrame, runs: DataFrame) -> DataFrame:
    """The states that the next run has to decide on: of urls touched since the ledger's horizon - all, where it is open -, computed from all
    their rows, without those whose version the ledger has as the last one of the url."""
    horizon = ledger.horizon()
    if horizon is not None:
        touched = touched_urls(urls, fetches, entries, runs, horizon)
        urls, fetches, entries = (df.join(touched, "url", "left_semi") for df in (urls, fetches, entries))
    return unprocessed(url_states(urls, fetches, entries, runs), ledger.last("url"), ["url"], "version")


def pending_stages(urls: DataFrame, fetches: DataFrame, entries: DataFrame, runs: DataFrame, horizon: datetime | None = None) -> DataFrame:
    """(url, stage) for each url whose page has to be fetched or parsed since the last success, from tables as url_states takes them. horizon: only
    urls with a fetch received from there on can be to parse - what is current of them is told by all their fetches; None for the
    first run."""
    states = url_states(urls, fetches, entries, runs)
    found = stages_of(states)
    if horizon is None:
        return found
    since = reread_from(fetches, F.col("received_at"), horizon).select("url").distinct()
    return found.where("stage = 'fetch'").unionByName(found.where("stage = 'parse'").join(since, "url", "left_semi"))
