"""Session construction and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Settings every job in this library relies on. Sizes are left to the cluster
#: (AQE coalesces small shuffle partitions), so nothing here is tuned to a laptop.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # rows of long texts go to Python workers in batches of bounded bytes
    "spark.sql.execution.arrow.maxBytesPerBatch": "4194304",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # of a repeated key in a JSON object the last value counts
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(app_name: str = "sparkloom", master: str | None = None, **extra: str) -> SparkSession:
    """Create (or fetch) a session with the settings above; ``extra`` names use ``_`` for ``.``."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in BASE_CONF.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("_", "."), value)
    return builder.getOrCreate()


def pin_runtime_conf(spark: SparkSession) -> SparkSession:
    """Apply the runtime-settable part of ``BASE_CONF`` to a session somebody else built."""
    for key, value in BASE_CONF.items():
        if spark.conf.isModifiable(key):
            spark.conf.set(key, value)
    return spark


def is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach.

    A cluster names it in ``spark.checkpoint.dir``; only a local session, where
    every executor thread shares this machine, may fall back to a temporary one.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not is_local(spark):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    fallback = tempfile.mkdtemp(prefix="sparkloom-")
    spark.conf.set("spark.checkpoint.dir", fallback)
    return fallback


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh sub-folder name under the shared folder, one per call."""
    return os.path.join(shared_dir(spark), f"{label}-{uuid.uuid4().hex}")


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write a frame to the shared folder and read it back.

    Cuts the plan before an iterative or repeated use; unlike cached blocks the
    files outlive a lost executor.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _file_system(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def complete_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the sub-folders that a Spark write has finished, sorted; none where the folder does not exist."""
    fs, where = _file_system(spark, path)
    if not fs.exists(where):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(where) if f.isDirectory()]
    return sorted(n for n in names if fs.exists(_file_system(spark, f"{path}/{n}/_SUCCESS")[1]))


def remove_folder(spark: SparkSession, path: str) -> None:
    fs, where = _file_system(spark, path)
    fs.delete(where, True)
