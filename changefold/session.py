"""Session settings the operators rely on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_STATE = "spark.sql.streaming.stateStore"
#: A commit uploads what it changed, not files written anew; memtables stay, so their memory is bounded per executor.
#: Blocks are compressed one by one, hence large ones. Counting all rows would read every row once more.
_STATE_FILES = {
    f"{_STATE}.rocksdb.changelogCheckpointing.enabled": "true", f"{_STATE}.rocksdb.boundedMemoryUsage": "true",
    f"{_STATE}.rocksdb.trackTotalNumberOfRows": "false", f"{_STATE}.rocksdb.compression": "zstd",
    f"{_STATE}.rocksdb.blockSizeKB": "32", f"{_STATE}.compression.codec": "zstd",
}
#: The JVM never compiles a larger method: Spark then makes smaller ones, operator by operator.
_METHOD_BYTES = "8000"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the session settings results depend on, and where streams keep their state.

    All epoch decoding is UTC. Streaming dedup keeps every key, so state lives on disk (RocksDB), compressed by zstd: it
    is there once in the checkpoint and once beside the executor that holds it.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set(_PROVIDER, _ROCKSDB)
    for name, value in _STATE_FILES.items():
        spark.conf.set(name, value)
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", _METHOD_BYTES)
    return spark


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach: what ``spark.checkpoint.dir`` names.

    Only a local master, where driver and executors are one process, may fall back to a
    temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if spark.sparkContext.master.split("[")[0] != "local":
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return tempfile.mkdtemp(prefix="changefold-")


def scratch(spark: SparkSession, label: str) -> str:
    """A new, not yet existing folder below the shared root."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"
