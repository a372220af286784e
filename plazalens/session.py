"""SparkSession construction and the shared scratch location.

On a cluster the session is created by the platform and already names a
shared ``spark.checkpoint.dir``; we only read it. Tests and local runs have
no such setting, so :func:`scratch_root` creates one under ``/tmp`` there; off
a local master a missing setting is an error, as executors would not share it.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Session settings the library relies on. Time zone is pinned because epoch
# and timestamp conversions are zone dependent; AQE re-plans joins by their
# runtime size and splits skewed shuffle partitions.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    # a join side too large to broadcast still prunes the other side before
    # its shuffle through a runtime Bloom filter (selective places filter)
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # rows go to Python workers in batches of so many bytes, whatever their width
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "plazalens",
    extra_conf: dict | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    # getOrCreate may hand back an existing session: make the SQL settings stick.
    for k, v in conf.items():
        if k.startswith("spark.sql."):
            spark.conf.set(k, v)
    scratch_root(spark)
    return spark


def scale_conf(shuffle_bytes: int, target_partition_bytes: int = 256 << 20,
               cores: int | None = None) -> dict:
    """Shuffle settings for an expected largest shuffle of ``shuffle_bytes``.

    Partitions of about ``target_partition_bytes`` (a few hundred MB fit in
    an executor's memory without much spill), never fewer than the cores;
    AQE coalesces small ones and splits skewed ones toward the same size.
    For example 5 TB of shuffled review rows gives 20,480 partitions.
    """
    n = max(cores or 1, -(-shuffle_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(128 << 20),
    }


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and layer tables.

    Read from ``spark.checkpoint.dir``; only when it is unset on a local master
    (tests) a fresh local folder is created and registered.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        try:
            root = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset key
            root = None
    if not root:
        if not sc.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="plazalens-ckpt-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", root)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused path below the shared scratch root."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


__all__ = ["get_session", "scratch_root", "scratch_path", "scale_conf", "DEFAULT_CONF"]
