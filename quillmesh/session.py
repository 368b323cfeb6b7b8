"""Sessions and the shared folder for tables that cut a lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "quillmesh", cores: str = "8", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and benchmarks on one machine; clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir of the session; where that is unset, as in tests, a temporary one."""
    set_by_cluster = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if set_by_cluster:
        return set_by_cluster.rstrip("/")
    if spark.sparkContext.master.startswith("local[") or spark.sparkContext.master == "local":
        own = spark.sparkContext.getCheckpointDir()
        if not own:
            spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="quillmesh-"))
            own = spark.sparkContext.getCheckpointDir()
        return own.rstrip("/")
    raise ValueError("set spark.checkpoint.dir to a folder that all executors share")


def _nodes(plan) -> list[str]:
    """The names of the nodes of a logical plan."""
    found, left = [], [plan]
    while left:
        node = left.pop()
        found.append(node.nodeName())
        below = node.children()
        left += [below.apply(i) for i in range(below.size())]
    return found


def spread(df: DataFrame) -> DataFrame:
    """df over all cores if a small input, as one file of one row group, would leave more than half of them idle. Worth a shuffle only ahead of
    work that takes much longer for each row than moving it; larger inputs come in more parts than that and stay as they are."""
    shuffles = {"Join", "Aggregate", "Sort", "Window", "Repartition", "RepartitionByExpression", "RebalancePartitions", "Distinct", "Deduplicate"}
    if shuffles & set(_nodes(df._jdf.queryExecution().optimizedPlan())):
        return df  # asking such a plan for its parts would run it; its shuffles spread the rows anyway
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if 2 * df.rdd.getNumPartitions() > cores else df.repartition(cores)


class Workspace:
    """Written tables of one run in the shared folder. A table survives the loss of executors, and a later stage starts from it
    instead of from the whole lineage; drop() removes one that a newer table has replaced."""

    def __init__(self, spark: SparkSession, purpose: str):
        self.spark, self.path = spark, f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex[:12]}"

    def write(self, df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{self.path}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.path}/{name}")

    def drop(self, name: str) -> None:
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
