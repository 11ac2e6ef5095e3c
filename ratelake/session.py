"""Session settings and the shared folder for data that must outlive an executor."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings the library relies on. Shuffle width is left to the cluster; AQE
# coalesces it and splits skewed partitions.
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "ratelake") -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in RECOMMENDED.items():
        builder = builder.config(key, value)
    return (
        builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("RATELAKE_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The cluster's folder for checkpoints and work tables.

    Read from ``spark.checkpoint.dir``. Only a local session may go without:
    a machine-local folder would be lost with its machine on a cluster.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    context.setCheckpointDir("file:" + tempfile.mkdtemp(prefix="ratelake-"))
    return context.getCheckpointDir().rstrip("/")


def work_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, label: str = "work") -> DataFrame:
    """Write ``df`` once below the shared folder and read it back.

    Unlike a checkpoint the copy is columnar: later passes read only the columns
    they use, and its size is known to the optimizer. It survives lost executors.
    """
    path = work_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]):
    """Session settings for the writes inside the block."""
    before = {name: spark.conf.get(name, None) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


# Creating a file costs the same however few rows it gets. Without this, a small
# write into many partitions would be merged into one task that opens them all.
SPREAD_FILES = {"spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k"}
