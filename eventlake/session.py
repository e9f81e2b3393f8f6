"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# SQL settings the operators rely on; every one can be set on a running session.
SQL_CONF = {
    # all event times are UTC wall-clock times
    "spark.sql.session.timeZone": "UTC",
    # a JSON object with a repeated key keeps the last value instead of failing to parse
    "spark.sql.variant.allowDuplicateKeys": "true",
    # partial overwrites replace only the partitions present in the written frame
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # AQE picks join strategies and partition counts from measured sizes and splits skewed ones
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # streaming state lives on disk beside the executors, checkpoints hold its changes
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the SQL settings above to a running session and return it."""
    for name, value in SQL_CONF.items():
        spark.conf.set(name, value)
    return spark


def local_session(app_name: str, cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Single-JVM session for tests and the bench; a cluster brings its own session."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach: ``spark.checkpoint.dir`` of the session.

    Without that setting it is the checkpoint folder set on the context. Only a local-mode session
    that has neither gets a temporary folder, because there every task runs on this machine.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by the whole cluster")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="eventlake-"))
    return context.getCheckpointDir()


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/eventlake/{label}-{uuid.uuid4().hex}"
