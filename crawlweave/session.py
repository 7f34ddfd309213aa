"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

RECOMMENDED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.python.filterPushdown.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": STATE_STORE,
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """Single-JVM session for tests and the benchmark; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("crawlweave")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in RECOMMENDED_CONF.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``, or a folder in the warehouse where that is not set."""
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir", None)
    if not root:
        root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(root)
    return root


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A path under the scratch folder that no other call uses."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a Parquet table in the scratch folder; cuts lineage, and its size is known to the planner."""
    path = fresh_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut lineage through reliable storage."""
    scratch_root(df.sparkSession)
    return df.checkpoint(eager=True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Buckets:
    """A scratch table in buckets of its keys; joins on these leave it where it is."""

    def __init__(self, spark: SparkSession, name: str, keys: Sequence[str]):
        self.spark, self.keys = spark, list(keys)
        self.path = fresh_dir(spark, name)
        self.table = f"{name}_{uuid.uuid4().hex}"
        self.count = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def append(self, df: DataFrame) -> None:
        placed = df.repartition(self.count, *self.keys)
        placed.write.bucketBy(self.count, *self.keys).option("path", self.path).mode("append").saveAsTable(self.table)

    def rows(self) -> DataFrame:
        return self.spark.table(self.table)

    def files(self) -> DataFrame:
        """The rows, also after the table is forgotten."""
        return self.spark.read.schema(self.rows().schema).parquet(self.path)

    def forget(self) -> None:
        """Drop the name; the files stay in the scratch folder."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")
